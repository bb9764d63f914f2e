"""Baskets and frequent itemsets.

Baskets are kept in long form, ``(basket_id, item)``. Itemsets are grown level
by level: candidates are joins of frequent sets all of whose subsets are
frequent, and their supports are counted in blocks (``support``), so that no
basket makes rows for the sets it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.columns import canonical
from earshot.operators.ordering import number_rows
from earshot.operators.ratings import qualified_plays
from earshot.operators.support import BLOCK_ITEMS, pair_supports, set_supports
from earshot.session import dealt, stage

# items of one array of a basket
BASKET_LIMIT = 100_000


def basket_items(plays: DataFrame, min_item_users: int = 10, min_user_songs: int = 5) -> DataFrame:
    """Each qualified listener's songs as basket rows."""
    return qualified_plays(plays, min_item_users, min_user_songs).select(
        F.col("user_id").alias("basket_id"), F.col("song_id").alias("item")
    )


def to_baskets(rows: DataFrame, limit: int = BASKET_LIMIT) -> DataFrame:
    """``(basket_id, part, items)`` with sorted distinct items.

    A basket beyond ``limit`` items is spread over several parts by hash, so no
    array grows with the data; all others have the single part 0.
    """
    counts = stage(
        rows.groupBy("basket_id").agg(F.ceil(F.count("*") / F.lit(limit)).cast("int").alias("parts")), "basket-parts"
    )
    part = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int")
    return (
        rows.join(counts, "basket_id")
        .select("basket_id", part.alias("part"), "item")
        # without this the parts of a basket would stay together where the join left them
        .repartition("basket_id", "part")
        .groupBy("basket_id", "part")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def basket_count(rows: DataFrame) -> int:
    """Number of distinct baskets."""
    ids = rows.select("basket_id")
    return dealt(ids, ids.count(), "basket_id").distinct().count()


def prune_baskets(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """Basket rows without the items that are not in ``frequent``."""
    return rows.join(frequent.select("item").distinct(), "item", "left_semi").select("basket_id", "item")


def _names(k: int) -> list[str]:
    return [f"i{p}" for p in range(1, k + 1)]


def _candidates(level: DataFrame, k: int) -> DataFrame:
    """Sets of ``k`` items all of whose subsets of ``k - 1`` items are in ``level``."""
    names, prefix = _names(k), _names(k - 2)
    left = level.select(*prefix, F.col(f"i{k - 1}").alias("a"))
    right = level.select(*prefix, F.col(f"i{k - 1}").alias("b"))
    sets = left.join(right, prefix).where("a < b").select(
        *prefix, F.col("a").alias(f"i{k - 1}"), F.col("b").alias(f"i{k}")
    )
    # the two subsets that end in the joined items are frequent by construction
    for gone in range(k - 2):
        rest = [n for i, n in enumerate(names) if i != gone]
        known = level.select(*[F.col(own).alias(n) for own, n in zip(_names(k - 1), rest)])
        sets = sets.join(known, rest, "left_semi").select(*names)
    return sets


def contained_sets(rows: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """Which of the given ``k``-item sets each basket contains, one item at a time.

    A basket makes no more rows than there are set prefixes, however many items
    it has. Rows are never broadcast: they take far more memory in a table of
    keys than in the file whose bytes Spark goes by.
    """
    found = rows.select("basket_id", F.col("item").alias("i1")).join(
        sets.select("i1").distinct(), "i1", "left_semi"
    )
    for size in range(2, k + 1):
        prefixes = sets.select(*_names(size)).distinct()
        found = found.join(prefixes, _names(size - 1)).join(
            rows.select("basket_id", F.col("item").alias(f"i{size}")).hint("merge"), ["basket_id", f"i{size}"], "left_semi"
        )
    return found.select("basket_id", *_names(k))


def occurrences(rows: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """``(basket_id, i1…ik)`` for each of the given sets in each basket."""
    wanted = reduce(
        DataFrame.unionByName, [sets.select(F.col(c).alias("item")) for c in _names(k)]
    ).distinct()
    return contained_sets(stage(prune_baskets(rows, wanted), "basket-rows"), sets, k)


def frequent_itemsets(
    rows: DataFrame, min_support: int = 15, max_size: int = 4, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """``(itemset, size, support)`` of all sets of up to ``max_size`` items in at least
    ``min_support`` baskets.

    Pairs are counted as matrices of ``block_items`` times ``block_items``
    items, larger sets as bitmaps; the same plan at every basket size.
    """
    pairs = rows.select("basket_id", "item")
    rows = stage(dealt(pairs, pairs.count(), "basket_id", "item").distinct(), "baskets")
    singles = stage(
        rows.groupBy(F.col("item").alias("i1")).agg(F.count("*").alias("support"))
        .where(F.col("support") >= min_support),
        "itemsets-1",
    )
    numbered = number_rows(singles.where("i1 IS NOT NULL").select(F.col("i1").alias("item")), ["item"], "code")
    codes = stage(numbered.select("item", (F.col("code") - 1).cast("int").alias("code")), "item-codes")
    coded = stage(rows.where("basket_id IS NOT NULL").join(codes, "item").select("basket_id", "code"), "coded-baskets")
    levels = []
    for k in range(2, max_size + 1):
        if k == 2:
            counted = pair_supports(coded, codes.count(), min_support, block_items)
        else:
            candidates = stage(_candidates(levels[-1], k), f"candidates-{k}")
            if candidates.isEmpty():
                break
            counted = set_supports(coded, candidates, _names(k), min_support)
        level = stage(counted, f"itemsets-{k}")
        if level.isEmpty():
            break
        levels.append(level)

    def named(level: DataFrame, k: int) -> DataFrame:
        for name in _names(k):
            level = level.join(codes.select(F.col("code").alias(name), F.col("item").alias(f"item_{name}")), name)
        return level.select(F.array(*[f"item_{n}" for n in _names(k)]).alias("itemset"), F.lit(k).alias("size"), "support")

    return reduce(DataFrame.unionByName, [
        singles.select(F.array("i1").alias("itemset"), F.lit(1).alias("size"), "support"),
        *[named(level, k) for k, level in enumerate(levels, start=2)],
    ])


def items_by_size(itemsets: DataFrame) -> DataFrame:
    """Distinct items among the frequent sets of each size."""
    return itemsets.select("size", F.explode("itemset").alias("item")).distinct()


def surviving_items(itemsets: DataFrame, max_size: int) -> DataFrame:
    """Items that occur in frequent sets of every size up to ``max_size``."""
    sizes = items_by_size(itemsets).groupBy("item").agg(F.count("*").alias("sizes"))
    return sizes.where(F.col("sizes") == max_size).select("item")


def set_columns(sets: DataFrame, column: str, k: int) -> DataFrame:
    """An itemset array column as the columns ``i1…ik``, in canonical order."""
    ordered = canonical(F.col(column))
    return sets.select("*", *[F.get(ordered, F.lit(p)).alias(name) for p, name in enumerate(_names(k))])
