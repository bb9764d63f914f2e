"""Queries on song features, listener profiles and linear models per listener."""

from pyspark.sql import functions as F

from earshot.operators import catalog as C
from earshot.operators import features as X
from earshot.operators import regression as G
from earshot.operators import scoring as S
from earshot.operators.activity import first_users
from earshot.operators.ordering import positional_split
from earshot.plans.content import recommend_by_content
from earshot.plans.profiles import profile_errors, user_profile
from earshot.session import stage
from earshot.sources.writers import user_path_lists
from earshot.suite import tables as T
from earshot.suite.activity import FIRST_COUNTS, user_paths
from earshot.suite.recommend import _rounded
from earshot.suite.registry import query
from earshot.suite.tables import with_tables

NAMES = ["size", "price", "flat"]


@query(with_tables("features", "SELECT song_id, size, price FROM features WHERE size IS NOT NULL"))
def numeric_song_features(spark, folder):
    rows = X.numeric_features(T.features(spark, folder), ["size", "price"], "song_id")
    return X.drop_nan(rows, ["size", "price"])


@query(with_tables("lines song_tracks", """SELECT user_id, song_id, track_id, play_count
    FROM lines JOIN song_tracks USING (song_id)"""))
def resolved_tracks(spark, folder):
    return X.resolve_tracks(T.lines(spark, folder), T.song_tracks(spark, folder)).drop("line")


@query(with_tables("user_paths", "SELECT user_id, song_id, track_id, path, play_count FROM user_paths"))
def resolved_paths(spark, folder):
    return user_paths(spark, folder).drop("line")


@query(with_tables("plays features", """SELECT user_id, song_id, play_count, track_id, size, price, flat
    FROM plays JOIN features USING (song_id)"""))
def plays_with_features(spark, folder):
    return X.join_features(T.plays(spark, folder), T.features(spark, folder))


LABELLED = {"labelled": """SELECT user_id, song_id, CAST(play_count AS DOUBLE) AS label, size, price, flat
    FROM plays JOIN features USING (song_id) WHERE size IS NOT NULL"""}


@query(with_tables("plays features", "SELECT * FROM labelled", LABELLED))
def labelled_plays(spark, folder):
    return G.labelled(T.plays(spark, folder), T.features(spark, folder), NAMES)


@query(with_tables("user_paths features", """SELECT size, price FROM user_paths JOIN features USING (track_id)
    WHERE user_id IN (SELECT user_id FROM user_paths GROUP BY 1 HAVING count(*) >= 10 ORDER BY min(line) LIMIT 26)"""))
def feature_pairs(spark, folder):
    paths = user_paths(spark, folder)
    users = first_users(paths, 10, 26)
    return X.feature_pairs(paths.join(users, "user_id", "left_semi"), T.features(spark, folder), "size", "price")


@query(with_tables("user_paths features", """SELECT user_id, path, track_id, features.song_id, size, price, flat
    FROM user_paths JOIN features USING (track_id)"""))
def user_features(spark, folder):
    lists = user_path_lists(user_paths(spark, folder))
    return X.user_features(lists, T.features(spark, folder))


COUNTS = {"first_counts": FIRST_COUNTS["first_counts"].replace(
    "SELECT user_id, path, play_count", "SELECT user_id, path, track_id, song_id, play_count")}


@query(with_tables("user_paths features", """SELECT user_id, track_id, c.song_id, size, price, flat, play_count
    FROM first_counts c JOIN features USING (track_id)""", COUNTS))
def features_with_play_count(spark, folder):
    counts = X.user_play_counts(
        T.lines(spark, folder), T.song_tracks(spark, folder), T.track_paths(spark, folder)
    )
    counts = stage(counts, "play-counts")
    rows = counts.select("user_id", "track_id").join(T.features(spark, folder), "track_id")
    return X.attach_play_count(rows, counts)


PROFILE = {
    **COUNTS,
    "profile": """SELECT user_id, path, song_id, track_id, play_count,
        coalesce(size, avg(size) OVER (PARTITION BY user_id), 0) AS size,
        coalesce(price, avg(price) OVER (PARTITION BY user_id), 0) AS price, flat,
        CASE WHEN max(play_count) OVER w = min(play_count) OVER w THEN 0
            ELSE CAST(play_count - min(play_count) OVER w AS DOUBLE)
                / (max(play_count) OVER w - min(play_count) OVER w) END AS label
        FROM first_counts JOIN (SELECT track_id, size, price, flat FROM features) USING (track_id)
        WINDOW w AS (PARTITION BY user_id)""",
}


def _profile(spark, folder):
    return user_profile(
        T.lines(spark, folder), T.song_tracks(spark, folder), T.track_paths(spark, folder),
        T.features(spark, folder), NAMES,
    )


@query(with_tables("user_paths features", """SELECT user_id, path, song_id, track_id, play_count,
    round(size, 9) AS size, round(price, 9) AS price, flat, round(label, 9) AS label FROM profile""", PROFILE))
def user_profiles(spark, folder):
    return _rounded(_profile(spark, folder), "size", "price", "label", digits=9)


@query(with_tables("plays", """SELECT user_id, song_id, play_count, round(CASE WHEN hi = lo THEN 0
    ELSE CAST(play_count - lo AS DOUBLE) / (hi - lo) END, 9) AS label
    FROM plays JOIN (SELECT user_id, min(play_count) AS lo, max(play_count) AS hi FROM plays GROUP BY 1)
    USING (user_id)"""))
def scaled_labels(spark, folder):
    return _rounded(X.minmax_label(T.plays(spark, folder)), "label", digits=9)


@query(with_tables("plays features", """SELECT user_id, song_id,
    round(coalesce(size, avg(size) OVER (PARTITION BY user_id), 0), 9) AS size
    FROM plays JOIN features USING (song_id)"""))
def imputed_features(spark, folder):
    rows = T.plays(spark, folder).join(T.features(spark, folder), "song_id").select("user_id", "song_id", "size")
    return _rounded(X.impute_mean(rows, ["size"]), "size", digits=9)


def _solved(source, where="TRUE"):
    """Least squares on two features in closed form; the constant third has weight 0.

    Where one feature is a multiple of the other, the weights of least norm.
    """
    return {
        "moments": f"""SELECT user_id, count(*) AS n, avg(size) AS m1, avg(price) AS m2, avg(label) AS my,
            var_pop(size) AS s11, var_pop(price) AS s22, covar_pop(size, price) AS s12,
            covar_pop(size, label) AS s1y, covar_pop(price, label) AS s2y
            FROM {source} WHERE {where} GROUP BY 1""",
        "weights": """SELECT user_id, n, m1, m2, my,
            CASE WHEN s11 * s22 - s12 * s12 < 1e-9 * s11 * s22
                THEN s1y / s11 / (1 + (s12 / s11) * (s12 / s11))
                ELSE (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) END AS w1,
            CASE WHEN s11 * s22 - s12 * s12 < 1e-9 * s11 * s22
                THEN s1y / s11 * (s12 / s11) / (1 + (s12 / s11) * (s12 / s11))
                ELSE (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) END AS w2 FROM moments""",
        "models": "SELECT user_id, n, w1, w2, my - w1 * m1 - w2 * m2 AS b FROM weights",
    }


MODEL_COLUMNS = """SELECT user_id, n AS n_rows, round(w1, 8) AS w_size, round(w2, 8) AS w_price,
    CAST(0 AS DOUBLE) AS w_flat, round(b, 6) AS intercept FROM models"""


def _model_columns(models):
    weight = [F.round(F.col("weights")[i], 8).alias(f"w_{name}") for i, name in enumerate(NAMES)]
    return models.select("user_id", "n_rows", *weight, F.round("intercept", 6).alias("intercept"))


def _labelled(spark, folder):
    return stage(G.labelled(T.plays(spark, folder), T.features(spark, folder), NAMES), "labelled")


@query(with_tables("plays features", MODEL_COLUMNS, {**LABELLED, **_solved("labelled")}))
def least_squares_models(spark, folder):
    return _model_columns(G.fit_ols(_labelled(spark, folder), NAMES))


DESCENT = {
    **LABELLED,
    "stats": """SELECT user_id, count(*) AS n, avg(size) AS m1, avg(price) AS m2,
        stddev_pop(size) AS s1, stddev_pop(price) AS s2,
        covar_pop(size, price) / (stddev_pop(size) * stddev_pop(price)) AS r,
        covar_pop(size, label) / stddev_pop(size) AS q1, covar_pop(price, label) / stddev_pop(price) AS q2
        FROM labelled GROUP BY 1""",
    "descent": """SELECT user_id, 0 AS t, CAST(0 AS DOUBLE) AS v1, CAST(0 AS DOUBLE) AS v2, FALSE AS done FROM stats
        UNION ALL
        SELECT user_id, t, CASE WHEN done THEN v1 ELSE n1 END, CASE WHEN done THEN v2 ELSE n2 END,
            done OR (t > 1 AND sqrt((n1 - v1) * (n1 - v1) + (n2 - v2) * (n2 - v2))
                < 0.001 * greatest(sqrt(n1 * n1 + n2 * n2), 1))
        FROM (SELECT d.user_id, t + 1 AS t, v1, v2, done,
                v1 - (v1 + r * v2 - q1) / sqrt(t + 1) AS n1, v2 - (r * v1 + v2 - q2) / sqrt(t + 1) AS n2
            FROM descent d JOIN stats USING (user_id) WHERE t < 10)""",
    "models": """SELECT user_id, n, v1 / s1 AS w1, v2 / s2 AS w2, - v1 / s1 * m1 - v2 / s2 * m2 AS b
        FROM descent JOIN stats USING (user_id) WHERE t = 10""",
}


@query(with_tables("plays features", MODEL_COLUMNS, DESCENT).replace("WITH ", "WITH RECURSIVE ", 1))
def descent_models(spark, folder):
    return _model_columns(G.fit_gradient_descent(_labelled(spark, folder), NAMES))


# coordinate descent on standardised features and label; the penalty is scaled by the label's deviation
ELASTIC_NET = {
    **LABELLED,
    "net": """SELECT count(*) AS n, avg(size) AS m1, avg(price) AS m2, avg(label) AS my, stddev_samp(size) AS s1,
        stddev_samp(price) AS s2, stddev_samp(label) AS sy, covar_pop(size, price) / (stddev_samp(size) * stddev_samp(price)) AS r,
        covar_pop(size, label) / (stddev_samp(size) * stddev_samp(label)) AS q1,
        covar_pop(price, label) / (stddev_samp(price) * stddev_samp(label)) AS q2,
        CAST(count(*) - 1 AS DOUBLE) / count(*) AS k, CAST(0.0003 AS DOUBLE) / stddev_samp(label) AS reg FROM labelled""",
    "steps": """SELECT 0 AS t, CAST(0 AS DOUBLE) AS v1, CAST(0 AS DOUBLE) AS v2 FROM net
        UNION ALL SELECT t, v1, sign(g2) * greatest(abs(g2) - 0.8 * reg, 0) / (k + 0.2 * reg) FROM (
            SELECT t, v1, q2 - r * v1 AS g2, reg, k FROM (
                SELECT t, sign(g1) * greatest(abs(g1) - 0.8 * reg, 0) / (k + 0.2 * reg) AS v1, reg, k, q2, r FROM (
                    SELECT t + 1 AS t, q1 - r * v2 AS g1, reg, k, q2, r FROM steps, net WHERE t < 100)))""",
    "fitted": """SELECT v1 * sy / s1 AS w1, v2 * sy / s2 AS w2, m1, m2, my FROM steps, net WHERE t = 100""",
}


# the same for every listener; one whose label does not vary keeps its mean
USER_NET = {
    **LABELLED,
    "net": """SELECT user_id, count(*) AS n, avg(size) AS m1, avg(price) AS m2, avg(label) AS my,
        stddev_pop(size) AS s1, stddev_pop(price) AS s2, stddev_pop(label) AS sy,
        covar_pop(size, price) / (stddev_pop(size) * stddev_pop(price)) AS r,
        covar_pop(size, label) / (stddev_pop(size) * stddev_pop(label)) AS q1,
        covar_pop(price, label) / (stddev_pop(price) * stddev_pop(label)) AS q2,
        CAST(0.05 AS DOUBLE) / stddev_pop(label) AS reg
        FROM labelled GROUP BY 1""",
    "steps": """SELECT user_id, 0 AS t, CAST(0 AS DOUBLE) AS v1, CAST(0 AS DOUBLE) AS v2 FROM net
            WHERE sy > 0 AND s1 > 0 AND s2 > 0
        UNION ALL SELECT user_id, t, v1, sign(g2) * greatest(abs(g2) - 0.8 * reg, 0) / (1 + 0.2 * reg) FROM (
            SELECT user_id, t, v1, q2 - r * v1 AS g2, reg FROM (
                SELECT user_id, t, sign(g1) * greatest(abs(g1) - 0.8 * reg, 0) / (1 + 0.2 * reg) AS v1, reg, q2, r FROM (
                    SELECT user_id, t + 1 AS t, q1 - r * v2 AS g1, reg, q2, r FROM steps JOIN net USING (user_id)
                    WHERE t < 100)))""",
    "models": """SELECT user_id, n, coalesce(v1 * sy / s1, 0) AS w1, coalesce(v2 * sy / s2, 0) AS w2,
        my - coalesce(v1 * sy / s1 * m1 + v2 * sy / s2 * m2, 0) AS b
        FROM net LEFT JOIN (SELECT * FROM steps WHERE t = 100) USING (user_id)""",
}


@query(with_tables("plays features", MODEL_COLUMNS, USER_NET).replace("WITH ", "WITH RECURSIVE ", 1))
def elastic_net_models(spark, folder):
    """One model per listener, with a penalty that some features of some listeners overcome."""
    return _model_columns(G.fit_user_elastic_net(_labelled(spark, folder), NAMES, reg_param=0.05))


@query(with_tables("plays features", """SELECT 'size' AS feature, round(w1, 5) AS coefficient FROM fitted
    UNION ALL SELECT 'price', round(w2, 5) FROM fitted UNION ALL SELECT 'flat', CAST(0 AS DOUBLE) FROM fitted
    UNION ALL SELECT '(intercept)', round(my - w1 * m1 - w2 * m2, 3) FROM fitted""", ELASTIC_NET)
    .replace("WITH ", "WITH RECURSIVE ", 1))
def elastic_net_model(spark, folder):
    """Run until it settles; the penalty is weak enough to leave both features in the model."""
    model = G.fit_elastic_net(_labelled(spark, folder), NAMES, max_iter=200, reg_param=0.0003)
    digits = F.when(F.col("feature") == "(intercept)", F.round("coefficient", 3)).otherwise(F.round("coefficient", 5))
    return model.select("feature", digits.alias("coefficient"))


@query(with_tables("plays features", """SELECT 'size' AS feature, CAST(0 AS DOUBLE) AS coefficient
    UNION ALL SELECT 'price', CAST(0 AS DOUBLE) UNION ALL SELECT 'flat', CAST(0 AS DOUBLE)
    UNION ALL SELECT '(intercept)', round(avg(label), 6) FROM labelled""", LABELLED))
def elastic_net_model_by_default(spark, folder):
    """The default penalty, which these features do not overcome: the mean is left."""
    return _rounded(G.fit_elastic_net(_labelled(spark, folder), NAMES), "coefficient")


@query(with_tables("plays features", """SELECT user_id, song_id, round(w1 * size + w2 * price + b, 6) AS prediction
    FROM labelled JOIN models USING (user_id)""", {**LABELLED, **_solved("labelled")}))
def linear_predictions(spark, folder):
    rows = _labelled(spark, folder)
    predicted = G.predict_linear(G.fit_ols(rows, NAMES), rows, NAMES)
    return _rounded(predicted.select("user_id", "song_id", "prediction"), "prediction")


@query(with_tables("plays features", """SELECT count(*) AS n, round(avg(e * e), 6) AS mse,
    round(sqrt(avg(e * e)), 6) AS rmse FROM (SELECT label - (w1 * size + w2 * price + b) AS e
    FROM labelled JOIN models USING (user_id))""", {**LABELLED, **_solved("labelled")}))
def training_error(spark, folder):
    rows = _labelled(spark, folder)
    return _rounded(G.mse(G.predict_linear(G.fit_ols(rows, NAMES), rows, NAMES)), "mse", "rmse")


@query(with_tables("user_paths features", """SELECT user_id, count(*) AS n, round(avg(e * e), 6) AS mse,
    round(sqrt(avg(e * e)), 6) AS rmse FROM (SELECT user_id, label - (w1 * size + w2 * price + b) AS e
    FROM numbered JOIN models USING (user_id) WHERE place > 21) GROUP BY 1""", {
    **PROFILE,
    "numbered": "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY song_id) AS place FROM profile",
    **_solved("numbered", "place <= 21"),
}))
def held_out_error(spark, folder):
    return _rounded(profile_errors(_profile(spark, folder), NAMES), "mse", "rmse")


@query(with_tables("user_paths features", """SELECT user_id, song_id,
    row_number() OVER (PARTITION BY user_id ORDER BY song_id) <= 21 AS is_train FROM profile""", PROFILE))
def split_profiles(spark, folder):
    return positional_split(_profile(spark, folder).select("user_id", "song_id"), 21)


SCORES = """SELECT user_id, song_id, w1 * size + w2 * price + b AS score
    FROM models CROSS JOIN features WHERE size IS NOT NULL"""


@query(with_tables("plays features", """SELECT song_id, count(*) AS users, round(avg(score), 6) AS mean_score,
    round(max(score), 6) AS best_score FROM scores GROUP BY 1""",
    {**LABELLED, **_solved("labelled"), "scores": SCORES}))
def all_song_scores(spark, folder):
    """Every song scored for every listener, summed up per song."""
    models = G.fit_ols(_labelled(spark, folder), NAMES)
    return _rounded(S.song_scores(models, T.features(spark, folder), NAMES), "mean_score", "best_score")


BEST = """SELECT user_id, song_id, round(score, 6) AS score, place FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY user_id ORDER BY round(score, 9) DESC, song_id) AS INTEGER) AS place FROM scores s
    WHERE NOT EXISTS (SELECT 1 FROM plays h WHERE h.user_id = s.user_id AND h.song_id = s.song_id))
    WHERE place <= 10"""


@query(with_tables("plays features", BEST, {**LABELLED, **_solved("labelled"), "scores": SCORES}))
def best_unheard_songs(spark, folder):
    plays = T.stored_plays(spark, folder)
    models = G.fit_ols(stage(G.labelled(plays, T.features(spark, folder), NAMES), "labelled"), NAMES)
    return _rounded(S.recommend_top_n(models, T.features(spark, folder), NAMES, plays, 10), "score")


@query(with_tables("plays features", BEST, {**DESCENT, "scores": SCORES}).replace("WITH ", "WITH RECURSIVE ", 1))
def content_recommendations(spark, folder):
    rows = recommend_by_content(T.plays(spark, folder), T.features(spark, folder), NAMES, 10)
    return _rounded(rows, "score")


def _full_rows(spark, folder):
    """Plays with all numeric features of their songs."""
    features = X.drop_nan(X.numeric_features(C.song_features(T.songs(spark, folder, full=True))))
    named = T.plays(spark, folder).withColumn("song_id", F.concat(F.lit("S"), F.col("song_id").cast("string")))
    return stage(G.labelled(named, features, X.NUMERIC_FEATURES), "full-rows")


def _wide_columns(models):
    weight = [F.round(F.col("weights")[i], 6).alias(f"w_{name}") for i, name in enumerate(X.NUMERIC_FEATURES)]
    return models.select("user_id", "n_rows", *weight, F.round("intercept", 6).alias("intercept"))


@query()
def full_width_least_squares_models(spark, folder):
    """Models on all 14 default features."""
    return _wide_columns(G.fit_ols(_full_rows(spark, folder), X.NUMERIC_FEATURES))


@query()
def full_width_descent_models(spark, folder):
    return _wide_columns(G.fit_gradient_descent(_full_rows(spark, folder), X.NUMERIC_FEATURES))


@query()
def full_width_elastic_net_models(spark, folder):
    return _wide_columns(G.fit_user_elastic_net(_full_rows(spark, folder), X.NUMERIC_FEATURES, reg_param=0.02, max_iter=1000))


@query()
def full_width_profile_errors(spark, folder):
    """Profiles on the nine default features, and the error of their models on held-out rows."""
    songs = C.profile_features(T.songs(spark, folder, full=True)).withColumnRenamed("trackID", "track_id")
    profile = user_profile(
        T.lines(spark, folder), T.song_tracks(spark, folder), T.track_paths(spark, folder), songs
    )
    return _rounded(profile_errors(profile), "mse", "rmse")
