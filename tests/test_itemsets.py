import itertools
import random

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from earshot.operators import blend as B
from earshot.operators import itemsets as I
from earshot.operators import rules as U
from earshot.operators.support import pair_supports

SCHEMA = "basket_id INT, item STRING"


def random_baskets(seed, baskets=60, items=9, share=0.4):
    rng = random.Random(seed)
    return {
        b: sorted(f"i{i}" for i in range(items) if rng.random() < share * (1.6 if b % 10 == 0 else 1))
        for b in range(baskets)
    }


def frame(spark, baskets):
    return spark.createDataFrame([(b, i) for b, found in baskets.items() for i in found], SCHEMA)


def brute_sets(baskets, support, max_size):
    counts = {}
    for items in baskets.values():
        for k in range(1, max_size + 1):
            for found in itertools.combinations(sorted(set(items)), k):
                counts[found] = counts.get(found, 0) + 1
    return {s: n for s, n in counts.items() if n >= support}


@pytest.mark.parametrize("part_items", [64, 3, 1])
@pytest.mark.parametrize("support", [1, 3, 6])
def test_itemsets_equal_brute_force_with_and_without_large_baskets(spark, part_items, support):
    baskets = random_baskets(1)
    baskets[60] = [f"i{i}" for i in range(9)]
    found = I.frequent_itemsets(frame(spark, baskets), support, 4, part_items).collect()
    got = {tuple(r.itemset): r.support for r in found}
    assert len(got) == len(found)
    assert got == brute_sets(baskets, support, 4)
    assert all(r.size == len(r.itemset) for r in found)


@pytest.mark.parametrize("options", [
    {}, {"pairs_at_once": 7}, {"small_basket": 5}, {"small_basket": 5, "pairs_at_once": 7}, {"pairs_of_cell": 0},
])
def test_pairs_of_small_baskets_equal_brute_force(spark, options):
    """Pairs counted by sorting: with items of many pairs, and with baskets left to the cells."""
    baskets = {b: sorted({int(i[1:]) for i in items} | {0}) for b, items in random_baskets(3).items()}
    rows = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "basket_id int, code int")
    got = {(r.i1, r.i2): r.support for r in pair_supports(rows, 9, 12, block_items=2, **options).collect()}
    assert got == {s: n for s, n in brute_sets(baskets, 12, 2).items() if len(s) == 2}


def test_small_baskets_make_no_cells(spark, monkeypatch):
    """Forty of 6,000 items a basket touch forty blocks and hundreds of cells with a pair or two each."""
    from earshot.operators import support

    monkeypatch.setattr(support, "_cells", lambda blocks: pytest.fail("cells of single pairs"))
    rng = random.Random(4)
    rows = [(b, i) for b in range(50) for i in {0, 1, *rng.sample(range(6000), 40)}]
    found = support.pair_supports(spark.createDataFrame(rows, "basket_id int, code int"), 6000, 30, block_items=100).collect()
    assert [(r.i1, r.i2, r.support) for r in found] == [(0, 1, 50)]


def test_many_large_baskets_equal_brute_force(spark):
    """Twenty baskets of hundreds of items, more of them than the support asks for."""
    rng = random.Random(9)
    baskets = {b: [f"i{i:03d}" for i in rng.sample(range(600), 300)] for b in range(20)}
    got = {tuple(r.itemset): r.support for r in I.frequent_itemsets(frame(spark, baskets), 16, 3).collect()}
    alone = {}
    for items in baskets.values():
        for i in items:
            alone[i] = alone.get(i, 0) + 1
    often = {i for i, n in alone.items() if n >= 16}
    assert got == brute_sets({b: [i for i in items if i in often] for b, items in baskets.items()}, 16, 3)


def test_candidates_have_all_subsets_frequent(spark):
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("a", "d"), ("b", "d"), ("c", "e"), ("a", "e")]
    level = spark.createDataFrame(pairs, "i1 STRING, i2 STRING")
    assert sorted(tuple(r) for r in I._candidates(level, 3).collect()) == [("a", "b", "c"), ("a", "b", "d"), ("a", "c", "e")]


def test_repeated_rows_count_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], SCHEMA)
    got = {tuple(r.itemset): r.support for r in I.frequent_itemsets(rows, 1).collect()}
    assert got == {("a",): 2, ("b",): 1, ("a", "b"): 1}


def test_itemsets_equal_fp_growth(spark):
    baskets = random_baskets(2, baskets=80)
    arrays = I.to_baskets(frame(spark, baskets))
    n = arrays.count()
    model = FPGrowth(itemsCol="items", minSupport=5 / n).fit(arrays)
    want = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect() if len(r["items"]) <= 4 and r.freq >= 5}
    got = {tuple(r.itemset): r.support for r in I.frequent_itemsets(frame(spark, baskets), 5).collect()}
    assert got == want
    for found in got:
        assert all(part in got for k in range(1, len(found)) for part in itertools.combinations(found, k))


def brute_rules(baskets, support, confidence, interest):
    sets = brute_sets(baskets, support, 4)
    rules = {}
    for found, n in sets.items():
        if len(found) == 4:
            for item in found:
                left = tuple(i for i in found if i != item)
                c = n / sets[left]
                i = c - sets[(item,)] / len(baskets)
                if c >= confidence and i >= interest:
                    rules[left, item] = (c, i)
    return rules


def test_rules_equal_brute_force(spark):
    baskets = {b: items for b, items in random_baskets(3).items() if items}
    rows = frame(spark, baskets)
    rules = U.filter_rules(U.association_rules(I.frequent_itemsets(rows, 3), len(baskets)))
    got = {(tuple(r.antecedent), r.consequent): (r.confidence, r.interest) for r in rules.collect()}
    want = brute_rules(baskets, 3, 0.04, 0.01)
    assert got.keys() == want.keys() and got
    assert all(got[r] == pytest.approx(want[r]) for r in want)
    assert all(c <= 1 for c, _ in got.values())
    ranked = [r.confidence for r in U.rank_rules(rules).collect()]
    assert ranked == sorted(ranked)


@pytest.mark.parametrize("exclude_heard", [True, False])
def test_rule_recommendations_equal_brute_force(spark, exclude_heard):
    baskets = {b: items for b, items in random_baskets(4).items() if items}
    rows = frame(spark, baskets)
    rules = U.filter_rules(U.association_rules(I.frequent_itemsets(rows, 3), len(baskets)))
    best = {}
    for (left, item), (c, _) in brute_rules(baskets, 3, 0.04, 0.01).items():
        best[left] = max(best.get(left, (0, "")), (round(c, 9), item))
    want = set()
    for b, items in baskets.items():
        for left in itertools.combinations(items, 3):
            if left in best and not (exclude_heard and best[left][1] in items):
                want.add((b, best[left][1]))
    got = U.rule_recommendations(rows, rules, exclude_heard).collect()
    assert {(r.basket_id, r["item"]) for r in got} == want and want
    assert len(got) == len(want)


def test_best_rule_takes_the_last_of_equals(spark):
    rules = spark.createDataFrame(
        [(["a", "b", "c"], "d", 0.5), (["a", "b", "c"], "e", 0.5), (["a", "b", "c"], "z", 0.4)],
        "antecedent ARRAY<STRING>, consequent STRING, confidence DOUBLE",
    )
    assert [r.consequent for r in U.best_rule(rules).collect()] == ["e"]


def test_contained_sets_needs_every_item(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "c")], SCHEMA)
    sets = spark.createDataFrame([("a", "b", "c"), ("a", "c", "d")], "i1 STRING, i2 STRING, i3 STRING")
    assert [tuple(r) for r in I.contained_sets(rows, sets, 3).collect()] == [(1, "a", "b", "c")]


def test_large_basket_is_split_into_parts_without_loss(spark):
    rows = spark.range(1000).select(F.lit(7).alias("basket_id"), F.col("id").cast("string").alias("item"))
    parts = I.to_baskets(rows, limit=100).collect()
    assert len(parts) > 5 and max(len(p["items"]) for p in parts) < 200
    assert sorted(i for p in parts for i in p["items"]) == sorted(str(i) for i in range(1000))


def test_blend_lists_rules_first_and_fills_up_to_the_cap(spark):
    rules = spark.createDataFrame([("u", "r2"), ("u", "r1"), ("v", "r1"), ("v", "r2"), ("v", "r3")], "user_id STRING, song_id STRING")
    scores = spark.createDataFrame(
        [("u", "r1", 9.0), ("u", "p1", 1.0), ("u", "p2", 2.0), ("u", "p3", 2.0), ("v", "p1", 5.0), ("w", "p1", 1.0)],
        "user_id STRING, song_id STRING, score DOUBLE",
    )
    listed = B.blend(rules, scores, 3).orderBy("user_id", "place").collect()
    by_user = {}
    for r in listed:
        by_user.setdefault(r.user_id, []).append((r.place, r.song_id, r.source))
    assert by_user == {
        "u": [(1, "r1", "rule"), (2, "r2", "rule"), (3, "p2", "prediction")],
        "v": [(1, "r1", "rule"), (2, "r2", "rule"), (3, "r3", "rule")],
        "w": [(1, "p1", "prediction")],
    }
    longer = B.blend(rules, scores, 2).where("user_id = 'v'").count()
    assert longer == 3, "rules are never cut"


def test_precision_is_null_without_recommendations(spark):
    listed = spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "c")], "user_id STRING, song_id STRING")
    hidden = spark.createDataFrame([("u", "b"), ("u", "x"), ("v", "a")], "user_id STRING, song_id STRING")
    got = {r.user_id: (r.hits, r.recommended, r.hidden, r.precision) for r in B.evaluate(listed, hidden).collect()}
    assert got == {"u": (1, 3, 2, pytest.approx(1 / 3)), "v": (0, 0, 1, None)}
