import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import features as X
from earshot.operators import ordering as O
from earshot.operators import regression as G
from earshot.operators import scoring as S
from earshot.operators.activity import first_users, for_user
from earshot.plans.content import recommend_by_content

NAMES = ["a", "b", "c", "flat"]
SCHEMA = "user_id STRING, song_id INT, label DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE, flat DOUBLE"


def random_rows(seed, counts):
    rng = random.Random(seed)
    return [
        (user, i, float(rng.randint(0, 9)), rng.random() * 100, 1e5 + rng.random() * 1e3, rng.gauss(0, 1e-2), 3.0)
        for user, n in counts.items() for i in range(n)
    ]


def matrix(rows, user):
    data = np.array([r[2:] for r in rows if r[0] == user])
    return data[:, 1:], data[:, 0]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = random_rows(1, {"many": 50, "three": 3, "two": 2, "one": 1})
    df = spark.createDataFrame(rows, SCHEMA)
    return rows, df, {r.user_id: r for r in G.fit_ols(df, NAMES).collect()}


def test_least_squares_equals_numpy(fitted):
    rows, _, models = fitted
    x, y = matrix(rows, "many")
    want, *_ = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)
    got = np.array(models["many"].weights)
    assert got == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert got[3] == 0.0
    residual = y - x @ got - models["many"].intercept
    assert np.abs((x - x.mean(0)).T @ residual).max() < 1e-5 and abs(residual.sum()) < 1e-6


def test_few_rows_give_the_least_norm(fitted):
    rows, _, models = fitted
    for user in ("three", "two", "one"):
        x, y = matrix(rows, user)
        want = np.linalg.pinv(x - x.mean(0), rcond=1e-9) @ (y - y.mean())
        assert np.array(models[user].weights) == pytest.approx(want, rel=1e-5, abs=1e-8)
        assert x @ np.array(models[user].weights) + models[user].intercept == pytest.approx(y, abs=1e-5)
        assert models[user].n_rows == len(y)


def test_predictions_and_error(fitted):
    rows, df, models = fitted
    known = df.where("user_id <> 'one'")
    predicted = G.predict_linear(G.fit_ols(known, NAMES), df, NAMES)
    assert predicted.where("user_id = 'one'").count() == 0
    x, y = matrix(rows, "many")
    error = np.mean((y - x @ np.array(models["many"].weights) - models["many"].intercept) ** 2)
    got = G.mse(predicted, by="user_id").where("user_id = 'many'").first()
    assert got.mse == pytest.approx(error) and got.rmse == pytest.approx(math.sqrt(error)) and got.n == 50


@pytest.mark.parametrize("tolerance", [0.0, 0.001])
@pytest.mark.parametrize("standardize", [True, False])
def test_descent_equals_full_passes_over_the_rows(spark, tolerance, standardize):
    rng = random.Random(5)
    rows = [("u", i, float(rng.randint(0, 9)), rng.random(), rng.random() * 2, rng.gauss(0, 1), 0.5) for i in range(40)]
    got = G.fit_gradient_descent(
        spark.createDataFrame(rows, SCHEMA), NAMES, step=0.5, tolerance=tolerance, standardize=standardize
    ).first()
    x, y = matrix(rows, "u")
    mean, std = (x.mean(0), x.std(0)) if standardize else (np.zeros(4), np.ones(4))
    scale = np.where(std > 1e-9, 1 / np.where(std > 1e-9, std, 1), 0)
    z, w = (x - mean) * scale, np.zeros(4)
    for t in range(1, 11):
        new = w - 0.5 / math.sqrt(t) * ((z @ w - y)[:, None] * z).mean(0)
        change, w = np.linalg.norm(new - w), new
        if t > 1 and change < tolerance * max(np.linalg.norm(w), 1.0):
            break
    assert np.array(got.weights) == pytest.approx(w * scale, abs=1e-9)
    assert got.intercept == pytest.approx(-(w * scale) @ mean, abs=1e-9)


def test_missing_values_do_not_enter_a_fit(spark):
    rows = random_rows(2, {"u": 20})
    full = G.fit_ols(spark.createDataFrame(rows, SCHEMA), NAMES).first()
    spoiled = rows + [("u", 99, 5.0, None, 1e5, 0.0, 3.0), ("u", 98, None, 1.0, 1e5, 0.0, 3.0)]
    again = G.fit_ols(spark.createDataFrame(spoiled, SCHEMA), NAMES).first()
    assert again.weights == pytest.approx(full.weights) and again.n_rows == 20


def test_elastic_net_shrinks(spark):
    df = spark.createDataFrame(random_rows(3, {"u": 60}), SCHEMA)
    strong = {r.feature: r.coefficient for r in G.fit_elastic_net(df, NAMES, reg_param=100.0).collect()}
    assert set(strong) == {*NAMES, "(intercept)"} and all(strong[n] == 0.0 for n in NAMES)


def test_elastic_net_per_listener_equals_spark_fits(spark):
    rows = random_rows(4, {"a": 60, "b": 25, "c": 9, "one": 1}) + [("same", i, 4.0, float(i), 1e5, 0.0, 3.0) for i in range(5)]
    rows = [(u, i, y + a / 20 - 3e-3 * (b - 1e5), a, b, c, f) if u != "same" else r for r in rows for u, i, y, a, b, c, f in [r]]
    df = spark.createDataFrame(rows, SCHEMA)
    for reg, mix in ((0.05, 0.8), (0.3, 0.8), (0.5, 0.0), (0.4, 1.0)):
        got = {r.user_id: r for r in G.fit_user_elastic_net(df, NAMES, reg_param=reg, elastic_net_param=mix, max_iter=500).collect()}
        assert got.keys() == {"a", "b", "c", "one", "same"}
        for user in "abc":
            own = G.fit_elastic_net(df.where(F.col("user_id") == user), NAMES, max_iter=2000, reg_param=reg, elastic_net_param=mix)
            want = {r.feature: r.coefficient for r in own.collect()}
            # Spark stops at a tolerance of its own, so effects are compared, not weights of tiny features
            spread = matrix(rows, user)[0].std(0)
            assert spread * got[user].weights == pytest.approx(spread * [want[n] for n in NAMES], abs=1e-4)
            fitted = sum(w * m for w, m in zip(got[user].weights, matrix(rows, user)[0].mean(0))) + got[user].intercept
            assert fitted == pytest.approx(matrix(rows, user)[1].mean())
        for user in ("one", "same"):
            assert got[user].weights == [0.0] * 4 and got[user].intercept == pytest.approx(matrix(rows, user)[1].mean())
    assert any(got["a"].weights) and got["a"].weights[3] == 0.0


def test_elastic_net_weights_meet_the_conditions_of_the_minimum(spark):
    """Gradients of the fit lie within the penalty where a weight is zero and on its edge where it is not."""
    rows = random_rows(6, {"u": 40, "v": 12})
    reg, mix = 0.4, 0.7
    for r in G.fit_user_elastic_net(spark.createDataFrame(rows, SCHEMA), NAMES, reg_param=reg, elastic_net_param=mix).collect():
        x, y = matrix(rows, r.user_id)
        x, w = x[:, :3], np.array(r.weights[:3])
        s, sy = x.std(0), y.std()
        slope = ((x / s) * (y - x @ w - r.intercept)[:, None]).mean(0) - reg * (1 - mix) / sy * w * s
        assert np.abs(slope[w == 0]).max(initial=0) <= reg * mix + 1e-8
        assert slope[w != 0] == pytest.approx(np.sign(w[w != 0]) * reg * mix, abs=1e-7)


def score_data(spark):
    rng = random.Random(7)
    models = [(u, [rng.gauss(0, 1), rng.gauss(0, 1)], rng.gauss(0, 1)) for u in range(23)] + [(99, [0.0, 0.0], 1.0)]
    songs = [(s, float(rng.randint(0, 3)), rng.random()) for s in range(57)] + [(1000, None, 1.0)]
    plays = [(u, s, 1) for u in range(23) for s in range(57) if rng.random() < 0.3] + [(0, 4711, 1), (500, 1, 1)]
    plays += [(5, s, 1) for s in range(57) if not any(p[:2] == (5, s) for p in plays)]
    return (
        models, songs, plays,
        spark.createDataFrame(models, "user_id BIGINT, weights ARRAY<DOUBLE>, intercept DOUBLE"),
        spark.createDataFrame(songs, "song_id BIGINT, a DOUBLE, b DOUBLE"),
        spark.createDataFrame(plays, "user_id BIGINT, song_id BIGINT, play_count BIGINT"),
    )


def test_block_scores_equal_brute_force(spark):
    models, songs, plays, m, s, p = score_data(spark)
    want = {(u, i): w[0] * a + w[1] * b + c for u, w, c in models for i, a, b in songs if a is not None}
    got = S.score_all(m, s, ["a", "b"], users_per_block=5, songs_per_block=10).collect()
    assert len(got) == len(want)
    assert all(r.score == pytest.approx(want[r.user_id, r.song_id]) for r in got)
    heard = {x[:2] for x in plays}
    best = S.recommend_top_n(m, s, ["a", "b"], p, 4, users_per_block=5, songs_per_block=10).collect()
    found = {}
    for r in sorted(best, key=lambda r: r.place):
        found.setdefault(r.user_id, []).append(r.song_id)
    for u, *_ in models:
        ranked = sorted((i for (v, i) in want if v == u and (u, i) not in heard), key=lambda i: (-round(want[u, i], 9), i))
        assert found.get(u, []) == ranked[:4]
    assert 5 not in found, "a listener who heard every song gets none"


def test_content_plan_recommends_only_unheard_songs(spark):
    _, songs, plays, _, s, p = score_data(spark)
    for method in ("descent", "exact"):
        rows = recommend_by_content(p, s, ["a", "b"], 3, method=method).collect()
        assert rows and not {(r.user_id, r.song_id) for r in rows} & {x[:2] for x in plays}
        assert all(r.place <= 3 and r.song_id != 1000 for r in rows)


def test_labels_and_imputation(spark):
    df = spark.createDataFrame(
        [("u", 1, 5, 1.0, True), ("u", 2, 15, None, True), ("u", 3, 25, 3.0, False), ("v", 1, 7, None, True), ("v", 2, 7, None, False)],
        "user_id STRING, song_id INT, play_count INT, x DOUBLE, is_train BOOLEAN",
    )
    labels = {(r.user_id, r.song_id): r.label for r in X.minmax_label(df).collect()}
    assert labels == {("u", 1): 0.0, ("u", 2): 0.5, ("u", 3): 1.0, ("v", 1): 0.0, ("v", 2): 0.0}
    on_train = {(r.user_id, r.song_id): r.label for r in X.minmax_label(df, train="is_train").collect()}
    assert on_train["u", 3] == 2.0
    filled = {(r.user_id, r.song_id): r.x for r in X.impute_mean(df, ["x"]).collect()}
    assert filled == {("u", 1): 1.0, ("u", 2): 2.0, ("u", 3): 3.0, ("v", 1): 0.0, ("v", 2): 0.0}
    assert {r.x for r in X.impute_mean(df, ["x"], train="is_train").where("song_id = 2 AND user_id = 'u'").collect()} == {1.0}


def test_first_play_of_a_path_counts(spark):
    plays = spark.createDataFrame(
        [("u", "s1", 3, 20), ("u", "s1", 9, 10), ("u", "s2", 4, 5), ("u", "gone", 1, 1)],
        "user_id STRING, song_id STRING, play_count BIGINT, line INT",
    )
    tracks = spark.createDataFrame([("s1", "T1"), ("s2", "T2")], "song_id STRING, track_id STRING")
    paths = spark.createDataFrame([("T1", "x/T1.h5")], "track_id STRING, path STRING")
    got = X.user_play_counts(plays, tracks, paths).select("user_id", "path", "play_count").collect()
    assert [tuple(r) for r in got] == [("u", "x/T1.h5", 9)]


def test_positional_split_and_numbering(spark):
    df = spark.createDataFrame([("u", i) for i in (5, 3, 9, 1)] + [("v", 2)], "user_id STRING, song_id INT")
    train = {(r.user_id, r.song_id) for r in O.positional_split(df, 2).where("is_train").collect()}
    assert train == {("u", 1), ("u", 3), ("v", 2)}
    many = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("x"))
    numbered = O.number_rows(many, ["x"]).collect()
    assert sorted((r.SongNumber, r.x) for r in numbered) == [(i + 1, i) for i in range(1000)]
    assert O.number_rows(many.where("x < 0"), ["x"]).count() == 0


def test_first_users_and_unknown_user(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 4), ("a", 5), ("c", 6)], "user_id STRING, line INT")
    assert [r.user_id for r in first_users(df, 2, 2).collect()] == ["b", "a"]
    assert for_user(df, "nobody").count() == 0


def solved(x, y):
    centred = x - x.mean(axis=0)
    w = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    return w


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e7])
@pytest.mark.parametrize("n", [8, 40])
def test_least_squares_far_from_all_others(spark, offset, n):
    """A listener far from the mean of all rows has the same digits as any other."""
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for user, at in (("near", 0.0), ("far", offset)):
        x = rng.normal(size=(n, 5)) + at
        y = (x - at) @ np.array([3.0, -2.0, 0.5, 1.0, -1.5]) + rng.normal(size=n) * 0.01
        want[user] = solved(x, y)
        rows += [(user, *map(float, r), float(label)) for r, label in zip(x, y)]
    names = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame(rows, "user_id STRING, " + ", ".join(f"{f} DOUBLE" for f in names) + ", label DOUBLE")
    for model in G.fit_ols(df.repartition(4), names).collect():
        assert np.allclose(model.weights, want[model.user_id], atol=1e-6 if offset < 1e7 else 1e-5)


def test_moments_are_not_shuffled(spark):
    """Rows are dealt by listener; only long listeners are reduced before the shuffle. Both give the same."""
    rows = spark.createDataFrame(random_rows(5, {"many": 60, "three": 3, "one": 1}), SCHEMA)

    def shuffled_partials(moments):
        plan = moments._jdf.queryExecution().executedPlan().toString().splitlines()
        lines = [line.lstrip(" :+-") for line in plan]
        return sum(above.startswith("Exchange") and "partial_" in below for above, below in zip(lines, lines[1:]))

    whole, split = G.user_moments(rows, NAMES), G.user_moments(rows, NAMES, whole_rows=10)
    assert shuffled_partials(whole) == 0 and shuffled_partials(split) == 1
    wanted = {r.user_id: r for r in whole.collect()}
    got = {r.user_id: r for r in split.collect()}
    assert got.keys() == wanted.keys() and {u: r.n_rows for u, r in got.items()} == {"many": 60, "three": 3, "one": 1}
    for user, r in got.items():
        assert r.covariance == pytest.approx(wanted[user].covariance, rel=1e-9, abs=1e-9)
        assert r.varies == wanted[user].varies and r.means == pytest.approx(wanted[user].means)


def test_few_leaves_are_scored_for_the_best_songs(spark, monkeypatch, tmp_path):
    """Ties, copies and heard songs as by brute force, while most blocks are never visited."""
    rng = np.random.default_rng(3)
    songs = [(i, float(rng.integers(0, 40)), float(np.round(rng.random(), 2))) for i in range(4000)]
    models = [(u, [float(np.cos(u)), float(30 * np.sin(u))] if u % 20 else [0.0, 0.0], float(u)) for u in range(60)]
    heard = [(u, int(i)) for u in range(60) for i in rng.integers(0, 4000, 30)] + [(1, i) for i in range(3995)]
    m = spark.createDataFrame(models, "user_id INT, weights ARRAY<DOUBLE>, intercept DOUBLE")
    s = spark.createDataFrame(songs, "song_id INT, a DOUBLE, b DOUBLE")
    p = spark.createDataFrame(heard, "user_id INT, song_id INT")
    staged = {}
    real = S.stage
    monkeypatch.setattr(S, "stage", lambda df, tag: staged.setdefault(tag, real(df, tag)))
    best = S.recommend_top_n(m, s, ["a", "b"], p, 5, users_per_block=8, songs_per_block=128).collect()
    got, skip = {}, set(heard)
    for r in sorted(best, key=lambda r: (r.user_id, r.place)):
        got.setdefault(r.user_id, []).append(r.song_id)
    for u, w, c in models:
        scores = [(-round(w[0] * a + w[1] * b + c, 9), i) for i, a, b in songs if (u, i) not in skip]
        assert got[u] == [i for _, i in sorted(scores)[:5]]
    visited = staged["sent-models"].where("user_id % 20 > 1").count()
    assert visited < 54 * 32 / 3
