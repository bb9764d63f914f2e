"""Supports counted by matrices and bitmaps, against sets of baskets."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot import session
from earshot.operators import itemsets as I
from earshot.operators import support as P

SCHEMA = "basket_id string, code int"


def dealt(seed, baskets=80, items=40, most=12):
    rng = random.Random(seed)
    return {f"b{b}": sorted(rng.sample(range(items), rng.randrange(0, most))) for b in range(baskets)}


def frame(spark, baskets):
    return spark.createDataFrame([(b, i) for b, found in baskets.items() for i in found], SCHEMA)


def brute(baskets, k, support):
    counts = {}
    for found in baskets.values():
        for chosen in itertools.combinations(found, k):
            counts[chosen] = counts.get(chosen, 0) + 1
    return {c: n for c, n in counts.items() if n >= support}


@pytest.mark.parametrize(("block_items", "entries"), [(2048, 10**6), (2048, 1), (7, 10**6), (7, 1), (1, 1)])
def test_pairs_by_blocks_and_splits(spark, monkeypatch, block_items, entries):
    monkeypatch.setattr(P, "PART_BLOCKS", 2)
    baskets = dealt(1)
    baskets["hot"] = list(range(40))
    out = P.pair_supports(frame(spark, baskets), 40, 3, block_items, entries).collect()
    assert {(r.i1, r.i2): r.support for r in out} == brute(baskets, 2, 3) and len(out) == len(brute(baskets, 2, 3))


@pytest.mark.parametrize(("entries", "at_once"), [(10**6, 10**6), (60, 10**6), (10**6, 9), (60, 9)])
def test_sets_by_parts_and_chunks(spark, entries, at_once):
    baskets = dealt(2, most=20)
    baskets["hot"] = list(range(40))
    wanted = brute(baskets, 3, 4)
    tried = [*wanted, (0, 1, 2), (37, 38, 39), (3, 9, 21)]
    sets = spark.createDataFrame(sorted(set(tried)), "i1 int, i2 int, i3 int")
    out = P.set_supports(frame(spark, baskets), sets, ["i1", "i2", "i3"], 4, entries, at_once).collect()
    assert {(r.i1, r.i2, r.i3): r.support for r in out} == wanted


def test_matrix_by_both_ways(monkeypatch):
    """Few pairs in memory and many by bitmaps give the same matrix."""
    rng = np.random.default_rng(3)
    lists = [np.flatnonzero(rng.random(50) < share) for share in rng.random(300)]
    sizes = np.array([len(x) for x in lists])
    flat = np.concatenate(lists)
    held = np.array([np.isin(np.arange(50), x) for x in lists]).astype(np.int64)
    for limit in (0, 100, 10**9):
        monkeypatch.setattr(P, "DENSE_PAIRS", limit)
        assert (P.count_cell(flat, sizes, flat, sizes, 50) == held.T @ held).all()


def test_bitmaps_in_small_pieces(monkeypatch):
    rng = np.random.default_rng(4)
    held = rng.random((700, 12)) < 0.4
    baskets, codes = np.nonzero(held)
    sets = np.array(list(itertools.combinations(range(12), 3)))
    wanted = [held[:, s].all(axis=1).sum() for s in sets]
    for size in (1, 4096, P.BITMAP_BYTES):
        monkeypatch.setattr(P, "BITMAP_BYTES", size)
        assert P.count_sets(baskets, codes, sets).tolist() == wanted


def test_a_third_of_all_rows_in_one_basket_makes_no_pair_rows(spark, monkeypatch):
    """The large basket has 2,000 frequent items, two million pairs; what is written stays below the rows read."""
    written = {}

    def counting(df, tag):
        out = session.stage(df, tag)
        written[tag] = out.count()
        return out

    monkeypatch.setattr(P, "stage", counting)
    monkeypatch.setattr(I, "stage", counting)
    large = spark.range(2000).select(F.lit(-1).alias("basket_id"), F.col("id").cast("string").alias("item"))
    small = spark.range(1000).select(
        F.col("id").alias("basket_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")
    ).select("basket_id", ((F.col("basket_id") * 4 + F.col("n")) % 2000).cast("string").alias("item"))
    rows = large.union(small)
    out = I.frequent_itemsets(rows, 3, 4, 512).groupBy("size").count().collect()
    # each group of four items is in the large basket and in two small ones
    assert {r["size"]: r["count"] for r in out} == {1: 2000, 2: 3000, 3: 2000, 4: 500}
    total = rows.count()
    assert all(n <= total for n in written.values()), written
    assert written["cell-counts"] <= 4 * 2000
