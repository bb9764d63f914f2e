"""Queries on similarity, prediction, itemsets, rules and blended recommendations."""

from pyspark.sql import functions as F

from earshot.operators import blend as B
from earshot.operators import itemsets as I
from earshot.operators import ratings as R
from earshot.operators import rules as U
from earshot.operators import similarity as S
from earshot.operators.activity import active_users, first_users
from earshot.plans.recommender import mine_rules, recommend, recommend_and_evaluate
from earshot.session import stage
from earshot.suite import tables as T
from earshot.suite.registry import query
from earshot.suite.tables import with_tables


def _ratings(spark, folder, scale="log2"):
    plays = stage(T.plays(spark, folder), "plays")
    return stage(R.to_ratings(plays, scale), "ratings")


def _first_listener(ratings):
    return ratings.agg(F.min("user_id")).first()[0]


def _rounded(df, *columns, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in columns else c for c in df.columns])


@query(with_tables("centered", "SELECT user_id, song_id, round(c, 9) AS centered FROM centered"))
def centered_ratings(spark, folder):
    return _rounded(R.center_by_item(_ratings(spark, folder)), "centered", digits=9).drop("rating")


@query(with_tables("norms", "SELECT song_id, round(norm, 9) AS norm FROM norms"))
def item_norms(spark, folder):
    return _rounded(R.item_norms(_ratings(spark, folder)), "norm", digits=9)


# similarity of the songs in `mine` to all other songs, then the prediction per target listener
SIMS = """SELECT a.song_id AS rated_song_id, b.song_id, round(sum(a.c * b.c) / (any_value(na.norm) * any_value(nb.norm)), 12) AS sim
    FROM centered a JOIN centered b ON a.user_id = b.user_id AND a.song_id <> b.song_id
    JOIN norms na ON na.song_id = a.song_id JOIN norms nb ON nb.song_id = b.song_id
    WHERE a.song_id IN (SELECT song_id FROM mine) AND na.norm > 0 AND nb.norm > 0
    GROUP BY 1, 2"""
NEAREST = """SELECT *, row_number() OVER (PARTITION BY user_id, song_id ORDER BY sim DESC, rated_song_id) AS place,
    count(*) OVER (PARTITION BY user_id, song_id) AS n
    FROM (SELECT m.user_id, s.song_id, s.rated_song_id, m.rating, s.sim
        FROM sims s JOIN mine m ON m.song_id = s.rated_song_id
        WHERE s.sim > 0 AND NOT EXISTS (SELECT 1 FROM mine h WHERE h.user_id = m.user_id AND h.song_id = s.song_id))"""
PREDICTED = """SELECT user_id, song_id, sum(rating * sim) / sum(sim) AS score
    FROM nearest WHERE place <= 50 AND n > 5 GROUP BY 1, 2"""
MINE = "SELECT user_id, song_id, rating FROM ratings WHERE user_id = (SELECT min(user_id) FROM ratings)"


def _prediction_tables(mine):
    return {"mine": mine, "sims": SIMS, "nearest": NEAREST, "predicted": PREDICTED}


RAW_RATINGS = "SELECT user_id, song_id, CAST(play_count AS DOUBLE) AS rating FROM by_user"


def _raw(sql):
    return sql.replace(T.SQL["ratings"], RAW_RATINGS)


@query(with_tables("norms", """SELECT rated_song_id, song_id, round(sim, 9) AS sim FROM sims
    WHERE sim > 0 AND song_id NOT IN (SELECT song_id FROM mine)""", {"mine": MINE, "sims": SIMS}))
def item_similarity(spark, folder):
    ratings = _ratings(spark, folder)
    mine = ratings.where(F.col("user_id") == F.lit(_first_listener(ratings)))
    return _rounded(S.item_similarity(ratings, mine), "sim", digits=9)


@query(with_tables("norms", """SELECT rated_song_id, song_id, round(sim, 9) AS sim, place FROM
    (SELECT *, CAST(row_number() OVER (PARTITION BY song_id ORDER BY sim DESC, rated_song_id) AS INTEGER) AS place
     FROM sims WHERE sim > 0 AND song_id NOT IN (SELECT song_id FROM mine)) WHERE place <= 5""",
    {"mine": MINE, "sims": SIMS}))
def top_neighbours(spark, folder):
    ratings = _ratings(spark, folder)
    mine = ratings.where(F.col("user_id") == F.lit(_first_listener(ratings)))
    return _rounded(S.top_neighbours(S.item_similarity(ratings, mine), 5), "sim", digits=9)


@query(with_tables("norms", "SELECT rated_song_id, song_id, round(sim, 9) AS sim FROM sims "
                   "WHERE sim >= 0.25 AND rated_song_id < song_id", {"mine": "SELECT DISTINCT song_id FROM ratings", "sims": SIMS}))
def similar_pairs_of_all_songs(spark, folder):
    return _rounded(S.similar_pairs(_ratings(spark, folder), 0.25), "sim", digits=9)


PREDICTIONS = with_tables("norms", """SELECT user_id, song_id, round(score, 6) AS score FROM predicted
    ORDER BY round(score, 9) DESC, song_id""", _prediction_tables(MINE))


@query(PREDICTIONS)
def predicted_ratings(spark, folder):
    """The flagship: ratings of one listener's unheard songs from log-scaled plays."""
    ratings = _ratings(spark, folder)
    predictions = S.predict_from_ratings(ratings, user_id=_first_listener(ratings))
    return _rounded(S.rank_predictions(predictions), "score")


@query(_raw(PREDICTIONS))
def predicted_ratings_raw(spark, folder):
    ratings = _ratings(spark, folder, "raw")
    predictions = S.predict_from_ratings(ratings, user_id=_first_listener(ratings))
    return _rounded(S.rank_predictions(predictions), "score")


@query(with_tables("norms lines", "SELECT user_id, song_id, round(score, 6) AS score FROM predicted",
    _prediction_tables("""SELECT user_id, song_id, rating FROM ratings WHERE user_id IN
    (SELECT user_id FROM lines GROUP BY 1 HAVING count(*) >= 30 ORDER BY min(line) LIMIT 11)""")))
def predicted_ratings_of_first_users(spark, folder):
    users = first_users(T.lines(spark, folder), 30, 11)
    return _rounded(S.predict_from_ratings(_ratings(spark, folder), users=users), "score")


@query(with_tables("norms", "SELECT user_id, song_id, round(score, 6) AS score FROM predicted",
    _prediction_tables("""SELECT user_id, song_id, rating FROM ratings WHERE user_id IN
    (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) >= (SELECT 1.3 * count(*) / count(DISTINCT user_id) FROM ratings))""")))
def predicted_ratings_of_active_users(spark, folder):
    """All listeners with well above the average number of songs."""
    ratings = _ratings(spark, folder)
    counts = stage(ratings.groupBy("user_id").agg(F.count("*").alias("n")), "song-counts")
    least = counts.agg(1.3 * F.sum("n") / F.count("*")).first()[0]
    return _rounded(S.predict_from_ratings(ratings, users=counts.where(F.col("n") >= least)), "score")


@query(with_tables("norms", """SELECT user_id, song_id, round(rating, 9) AS rating, round(sim, 9) AS sim FROM rows
    WHERE user_id IN (SELECT user_id FROM rows GROUP BY 1 HAVING count(*) > 1)""", {
    "mine": "SELECT min(song_id) AS song_id FROM ratings",
    "sims": SIMS,
    "rows": "SELECT user_id, song_id, rating, sim FROM ratings JOIN sims USING (song_id) WHERE sim > 0",
}))
def similar_items(spark, folder):
    ratings = _ratings(spark, folder)
    rows = S.similar_items(ratings, ratings.agg(F.min("song_id")).first()[0])
    return _rounded(rows, "rating", "sim", digits=9)


# ---- itemsets and rules over the brands of an order ----

ITEMSETS = {
    "l1": "SELECT item AS i1, count(*) AS support FROM order_brands GROUP BY 1 HAVING count(*) >= 15",
    "l2": """SELECT a.item AS i1, b.item AS i2, count(*) AS support FROM order_brands a
        JOIN order_brands b ON a.basket_id = b.basket_id AND a.item < b.item
        GROUP BY 1, 2 HAVING count(*) >= 15""",
    "l3": """SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS support FROM order_brands a
        JOIN order_brands b ON a.basket_id = b.basket_id AND a.item < b.item
        JOIN order_brands c ON a.basket_id = c.basket_id AND b.item < c.item
        GROUP BY 1, 2, 3 HAVING count(*) >= 15""",
    "l4": """SELECT a.item AS i1, b.item AS i2, c.item AS i3, d.item AS i4, count(*) AS support FROM order_brands a
        JOIN order_brands b ON a.basket_id = b.basket_id AND a.item < b.item
        JOIN order_brands c ON a.basket_id = c.basket_id AND b.item < c.item
        JOIN order_brands d ON a.basket_id = d.basket_id AND c.item < d.item
        GROUP BY 1, 2, 3, 4 HAVING count(*) >= 15""",
    "itemsets": """SELECT i1 AS itemset, CAST(1 AS INTEGER) AS size, support FROM l1
        UNION ALL SELECT i1 || '|' || i2, 2, support FROM l2
        UNION ALL SELECT i1 || '|' || i2 || '|' || i3, 3, support FROM l3
        UNION ALL SELECT i1 || '|' || i2 || '|' || i3 || '|' || i4, 4, support FROM l4""",
}
RULES = {
    **ITEMSETS,
    "split": """SELECT i2 AS a1, i3 AS a2, i4 AS a3, i1 AS consequent, support FROM l4
        UNION ALL SELECT i1, i3, i4, i2, support FROM l4
        UNION ALL SELECT i1, i2, i4, i3, support FROM l4
        UNION ALL SELECT i1, i2, i3, i4, support FROM l4""",
    "all_rules": """SELECT a1, a2, a3, a1 || '|' || a2 || '|' || a3 AS antecedent, consequent,
        CAST(split.support AS DOUBLE) / l3.support AS confidence,
        CAST(split.support AS DOUBLE) / l3.support - CAST(l1.support AS DOUBLE)
            / (SELECT count(DISTINCT basket_id) FROM order_brands) AS interest
        FROM split JOIN l3 ON l3.i1 = a1 AND l3.i2 = a2 AND l3.i3 = a3 JOIN l1 ON l1.i1 = consequent""",
    "rules": "SELECT * FROM all_rules WHERE confidence >= 0.04 AND interest >= 0.01",
    "best": """SELECT a1, a2, a3, antecedent, consequent, confidence FROM (SELECT *, row_number() OVER
        (PARTITION BY antecedent ORDER BY round(confidence, 9) DESC, consequent DESC) AS rn FROM rules) WHERE rn = 1""",
    "rule_items": """SELECT consequent AS item FROM rules UNION SELECT a1 FROM rules
        UNION SELECT a2 FROM rules UNION SELECT a3 FROM rules""",
    "matched": """SELECT x.basket_id, r.antecedent, r.consequent FROM order_brands x
        JOIN best r ON r.a1 = x.item
        JOIN order_brands y ON y.basket_id = x.basket_id AND y.item = r.a2
        JOIN order_brands z ON z.basket_id = x.basket_id AND z.item = r.a3""",
}


def _joined(df, *columns):
    return df.select(*[F.array_join(c, "|").alias(c) if c in columns else c for c in df.columns])


def _baskets(spark, folder):
    return stage(T.order_brands(spark, folder), "order-brands")


def _itemsets(spark, folder):
    return I.frequent_itemsets(T.order_brands(spark, folder))


def _rules(rows):
    return stage(mine_rules(rows), "rules")


@query(with_tables("order_brands", "SELECT * FROM itemsets", ITEMSETS))
def frequent_itemsets(spark, folder):
    return _joined(_itemsets(spark, folder), "itemset")


@query(with_tables("by_user", """SELECT i1 AS itemset, 1 AS size, support FROM l1
    UNION ALL SELECT i1 || '|' || i2, 2, support FROM l2
    UNION ALL SELECT i1 || '|' || i2 || '|' || i3, 3, support FROM l3""", {
    "songs": "SELECT user_id, lpad(CAST(song_id AS VARCHAR), 9, '0') AS song FROM by_user",
    "l1": "SELECT song AS i1, count(*) AS support FROM songs GROUP BY 1 HAVING count(*) >= 6",
    "l2": """SELECT a.song AS i1, b.song AS i2, count(*) AS support FROM songs a JOIN songs b
        ON a.user_id = b.user_id AND a.song < b.song GROUP BY 1, 2 HAVING count(*) >= 6""",
    "l3": """SELECT a.song AS i1, b.song AS i2, c.song AS i3, count(*) AS support FROM songs a
        JOIN songs b ON a.user_id = b.user_id AND a.song < b.song
        JOIN songs c ON a.user_id = c.user_id AND b.song < c.song GROUP BY 1, 2, 3 HAVING count(*) >= 6""",
}))
def song_itemsets(spark, folder):
    """Songs that at least six listeners have in common, by ones, twos and threes."""
    rows = I.basket_items(stage(T.plays(spark, folder), "plays"))
    named = rows.select("basket_id", F.lpad(F.col("item").cast("string"), 9, "0").alias("item"))
    return _joined(I.frequent_itemsets(named, 6, 3), "itemset")


@query(with_tables("order_brands", """SELECT basket_id, CAST(0 AS INTEGER) AS part,
    string_agg(item, '|' ORDER BY item) AS items FROM order_brands GROUP BY 1"""))
def order_baskets(spark, folder):
    return _joined(I.to_baskets(_baskets(spark, folder)), "items")


@query(with_tables("order_brands", """SELECT basket_id, item FROM order_brands WHERE item IN
    (SELECT item FROM order_brands GROUP BY 1
        HAVING count(*) >= (SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT item) FROM order_brands))"""))
def pruned_baskets(spark, folder):
    """Basket rows of the items that are in at least as many baskets as the average item."""
    rows = _baskets(spark, folder)
    counts = rows.groupBy("item").agg(F.count("*").alias("n"))
    mean = counts.agg(F.avg("n")).first()[0]
    return I.prune_baskets(rows, counts.where(F.col("n") >= F.lit(mean)))


@query(with_tables("order_brands", """SELECT DISTINCT size, item FROM (
    SELECT CAST(1 AS INTEGER) AS size, i1 AS item FROM l1
    UNION ALL SELECT 2, unnest([i1, i2]) FROM l2
    UNION ALL SELECT 3, unnest([i1, i2, i3]) FROM l3
    UNION ALL SELECT 4, unnest([i1, i2, i3, i4]) FROM l4)""", ITEMSETS))
def frequent_items_by_size(spark, folder):
    return I.items_by_size(_itemsets(spark, folder))


@query(with_tables("order_brands", """SELECT i1 AS item FROM l1
    INTERSECT SELECT unnest([i1, i2]) FROM l2
    INTERSECT SELECT unnest([i1, i2, i3]) FROM l3
    INTERSECT SELECT unnest([i1, i2, i3, i4]) FROM l4""", ITEMSETS))
def surviving_items(spark, folder):
    return I.surviving_items(_itemsets(spark, folder), 4)


@query(with_tables("order_brands", """SELECT antecedent, consequent, round(confidence, 9) AS confidence,
    round(interest, 9) AS interest FROM all_rules""", RULES))
def association_rules(spark, folder):
    rows = _baskets(spark, folder)
    n_baskets = I.basket_count(rows)
    rules = U.association_rules(I.frequent_itemsets(rows), n_baskets)
    return _rounded(_joined(rules, "antecedent"), "confidence", "interest", digits=9)


@query(with_tables("order_brands", """SELECT antecedent, consequent, round(confidence, 9) AS confidence,
    round(interest, 9) AS interest FROM rules ORDER BY confidence, antecedent, consequent""", RULES))
def ranked_rules(spark, folder):
    rules = U.rank_rules(_rules(_baskets(spark, folder)))
    return _rounded(_joined(rules, "antecedent"), "confidence", "interest", digits=9)


@query(with_tables("order_brands", """SELECT antecedent, consequent, round(confidence, 9) AS confidence
    FROM best""", RULES))
def best_rules(spark, folder):
    rows = _baskets(spark, folder)
    return _rounded(_joined(U.best_rule(_rules(rows)), "antecedent"), "confidence", digits=9)


@query(with_tables("order_brands", "SELECT item FROM rule_items", RULES))
def rule_items(spark, folder):
    return U.rule_items(_rules(_baskets(spark, folder)))


@query(with_tables("order_brands", """SELECT basket_id, item FROM order_brands
    WHERE item IN (SELECT item FROM rule_items)""", RULES))
def associated_items(spark, folder):
    rows = _baskets(spark, folder)
    return U.associated_items(rows, _rules(rows))


@query(with_tables("order_brands", "SELECT basket_id, antecedent, consequent FROM matched", RULES))
def matched_rules(spark, folder):
    rows = _baskets(spark, folder)
    return _joined(U.match_rules(rows, U.best_rule(_rules(rows))), "antecedent")


RULE_RECS = """SELECT DISTINCT m.basket_id, m.consequent AS item FROM matched m"""


@query(with_tables("order_brands", RULE_RECS + """ WHERE NOT EXISTS (SELECT 1 FROM order_brands h
    WHERE h.basket_id = m.basket_id AND h.item = m.consequent)""", RULES))
def rule_recommendations(spark, folder):
    rows = _baskets(spark, folder)
    return U.rule_recommendations(rows, _rules(rows))


@query(with_tables("order_brands", RULE_RECS, RULES))
def rule_recommendations_with_heard(spark, folder):
    rows = _baskets(spark, folder)
    return U.rule_recommendations(rows, _rules(rows), exclude_heard=False)


# ---- blended recommendations for all orders with enough brands, scored on later plays ----

SETTINGS = dict(scale="raw", min_user_songs=4, min_support=8, cap=12)

BLEND = {
    "order_plays": f"""SELECT o_orderkey AS user_id, p_brand AS song_id,
        l_shipdate >= TIMESTAMP '{T.HIDDEN_FROM}' AS hidden,
        CAST(SUM(CAST(CEIL(l_quantity / 5) AS BIGINT)) AS BIGINT) AS play_count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""",
    "plays": "SELECT user_id, song_id, play_count FROM order_plays WHERE NOT hidden",
    "hidden_plays": "SELECT user_id, song_id FROM order_plays WHERE hidden",
    "targets": """SELECT user_id FROM plays GROUP BY 1 HAVING count(*) >= 7""",
    "by_song": T.SQL["by_song"],
    "by_user": T.SQL["by_user"].replace(">= 5", ">= 4"),
    "ratings": RAW_RATINGS,
    "centered": T.SQL["centered"],
    "norms": T.SQL["norms"],
    **_prediction_tables("SELECT user_id, song_id, rating FROM ratings WHERE user_id IN (SELECT user_id FROM targets)"),
    "order_brands": "SELECT user_id AS basket_id, song_id AS item FROM ratings",
    **{name: text.replace(">= 15", ">= 8") for name, text in RULES.items()},
    "by_rule": """SELECT DISTINCT basket_id AS user_id, consequent AS song_id FROM matched m
        WHERE basket_id IN (SELECT user_id FROM targets) AND NOT EXISTS (SELECT 1 FROM order_brands h
        WHERE h.basket_id = m.basket_id AND h.item = m.consequent)""",
    "blended": """SELECT user_id, song_id, source, row_number() OVER (PARTITION BY user_id
            ORDER BY source DESC, round(score, 9) DESC, song_id) AS place FROM (
        SELECT user_id, song_id, 'rule' AS source, CAST(0 AS DOUBLE) AS score FROM by_rule
        UNION ALL SELECT user_id, song_id, 'prediction', score FROM predicted p
        WHERE NOT EXISTS (SELECT 1 FROM by_rule r WHERE r.user_id = p.user_id AND r.song_id = p.song_id))""",
    "listed": "SELECT * FROM blended WHERE place <= 12 OR source = 'rule'",
}


def _blend_inputs(spark, folder):
    rows = stage(T.order_plays(spark, folder), "order-plays")
    visible = rows.where(~F.col("hidden")).select("user_id", "song_id", "play_count")
    hidden = rows.where("hidden").select("user_id", "song_id")
    users = active_users(visible, 7).select("user_id")
    return visible, hidden, stage(users, "targets")


def _with(body):
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in BLEND.items()) + "\n" + body


@query(_with("SELECT user_id, song_id, source, place FROM listed"))
def blended_recommendations(spark, folder):
    visible, _, users = _blend_inputs(spark, folder)
    return recommend(visible, users, **SETTINGS)


@query(_with("SELECT user_id, song_id FROM listed INTERSECT SELECT user_id, song_id FROM hidden_plays"))
def recommendation_hits(spark, folder):
    visible, hidden, users = _blend_inputs(spark, folder)
    return B.hits(recommend(visible, users, **SETTINGS), hidden)


@query(_with("""SELECT user_id, count(r) FILTER (WHERE h IS NOT NULL) AS hits, count(r) AS recommended,
    count(h) AS hidden, round(CAST(count(r) FILTER (WHERE h IS NOT NULL) AS DOUBLE) / nullif(count(r), 0), 9) AS precision
    FROM (SELECT user_id, song_id, 1 AS r FROM listed) FULL JOIN
    (SELECT DISTINCT user_id, song_id, 1 AS h FROM hidden_plays WHERE user_id IN (SELECT user_id FROM targets))
    USING (user_id, song_id) GROUP BY 1"""))
def evaluated_recommendations(spark, folder):
    visible, hidden, users = _blend_inputs(spark, folder)
    return _rounded(recommend_and_evaluate(visible, hidden, users, **SETTINGS), "precision", digits=9)
