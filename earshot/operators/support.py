"""Supports of item sets counted in blocks, without a row per pair of items.

Rows are ``(basket_id, code)`` with items numbered 0, 1, …. Pairs are counted in
cells of two blocks of items: a cell adds up a matrix of counts over its
baskets, and only whole rows of matrices leave it. Where a basket has few items
in a cell, an item goes with the later ones of its basket to the task that
counts all its pairs. Larger sets are counted from
bitmaps, one per item over the baskets of a part: the support of a set is the
number of bits left when its items' bitmaps are joined by AND.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.session import dealt, ship_with_jobs, stage

# items of a block; a cell's matrix has the square of it
BLOCK_ITEMS = 2048
# rows of the baskets that one task takes at once; a cell takes a quarter of its matrix if that is more
ENTRIES = 250_000
# baskets with more pairs than this in a cell are counted by bitmaps, the others pair by pair in memory
DENSE_PAIRS = 8192
# candidate sets of a chunk
CANDIDATES = 100_000
# blocks of a basket that one task pairs with the others
PART_BLOCKS = 64
BITMAP_BYTES = 32 << 20
# pairs that one task counts by sorting, of baskets with so many items at most
PAIRS = 1 << 22
SMALL_BASKET = 256
# cells with fewer pairs than this on average cost more than the pairs
PAIRS_OF_CELL = 64


def bit_rows(rows: np.ndarray, places: np.ndarray, n_rows: int, n_places: int) -> np.ndarray:
    """A bitmap per row with the given places set."""
    bits = np.zeros((n_rows, -(-max(n_places, 1) // 64)), dtype=np.uint64)
    np.bitwise_or.at(bits, (rows, places >> 6), np.uint64(1) << (places & 63).astype(np.uint64))
    return bits


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy(zero_copy_only=False)


def count_cell(left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, width: int) -> np.ndarray:
    """How many baskets hold each pair of a left and a right item; items of a basket follow one another."""
    counts = np.zeros((width, width), dtype=np.int64)
    pairs = n_left.astype(np.int64) * n_right
    from_left, from_right = np.cumsum(n_left) - n_left, np.cumsum(n_right) - n_right
    few = np.flatnonzero((pairs > 0) & (pairs <= DENSE_PAIRS))
    # pieces of about as many pairs as the matrix has cells
    step = np.cumsum(pairs[few]) // max(width * width, 1 << 20)
    for piece in np.split(few, np.flatnonzero(np.diff(step)) + 1):
        n = pairs[piece]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        by = np.repeat(n_right[piece], n)
        a = left[np.repeat(from_left[piece], n) + within // by]
        b = right[np.repeat(from_right[piece], n) + within % by]
        counts += np.bincount(a * width + b, minlength=width * width).reshape(width, width)
    many = np.flatnonzero(pairs > DENSE_PAIRS)
    for start in range(0, len(many), 4096):
        piece = many[start:start + 4096]
        place_left, place_right = (np.repeat(np.arange(len(piece)), n[piece]) for n in (n_left, n_right))
        items_left = np.concatenate([left[from_left[i]:from_left[i] + n_left[i]] for i in piece])
        items_right = np.concatenate([right[from_right[i]:from_right[i] + n_right[i]] for i in piece])
        bits_left = bit_rows(items_left, place_left, width, len(piece))
        bits_right = bit_rows(items_right, place_right, width, len(piece))
        for item in np.unique(items_left):
            counts[item] += np.bitwise_count(bits_left[item] & bits_right).sum(axis=1, dtype=np.int64)
    return counts


def count_sets(baskets: np.ndarray, codes: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """How many of the baskets hold all items of each set (rows of ``sets``), from bitmaps."""
    supports = np.zeros(len(sets), dtype=np.int64)
    items = np.unique(sets)
    known = np.isin(codes, items)
    baskets, codes = baskets[known], np.searchsorted(items, codes[known])
    # a basket with fewer of the items than a set has cannot hold one
    enough = np.bincount(baskets, minlength=1) >= sets.shape[1]
    number = np.cumsum(enough) - 1
    held = enough[baskets]
    baskets, codes = number[baskets[held]], codes[held]
    places = np.searchsorted(items, sets)
    n, step = int(enough.sum()), max(64, BITMAP_BYTES * 8 // max(len(items), 1) // 64 * 64)
    order = np.argsort(baskets, kind="stable")
    baskets, codes = baskets[order], codes[order]
    for first in range(0, n, step):
        lo, hi = np.searchsorted(baskets, [first, first + step])
        bits = bit_rows(codes[lo:hi], baskets[lo:hi] - first, len(items), min(step, n - first))
        at_once = max(1, BITMAP_BYTES // (8 * bits.shape[1]))
        for start in range(0, len(sets), at_once):
            part = places[start:start + at_once]
            joined = reduce(np.bitwise_and, (bits[part[:, i]] for i in range(part.shape[1])))
            supports[start:start + at_once] += np.bitwise_count(joined).sum(axis=1, dtype=np.int64)
    return supports


def _cells(blocks: DataFrame) -> DataFrame:
    """``lo``, ``hi``, ``basket_id``, ``left``, ``right``: the blocks of a basket by twos, and each alone.

    A basket's blocks meet part by part, so one with very many is spread over
    tasks.
    """
    alone = blocks.select(
        F.col("block").alias("lo"), F.col("block").alias("hi"), "basket_id", F.col("items").alias("left"), F.col("items").alias("right")
    )
    sizes = stage(
        blocks.groupBy("basket_id").agg(F.ceil(F.count("*") / PART_BLOCKS).cast("int").alias("parts")), "basket-blocks"
    )
    known = blocks.join(sizes, "basket_id")
    first = known.select(
        "basket_id", F.pmod(F.col("block"), F.col("parts")).alias("at"), F.col("block").alias("lo"), F.col("items").alias("left")
    )
    second = known.select(
        "basket_id", F.explode(F.expr("sequence(0, parts - 1)")).alias("at"), F.col("block").alias("hi"), F.col("items").alias("right")
    )
    return alone.union(
        first.join(second, ["basket_id", "at"]).where("lo < hi").select("lo", "hi", "basket_id", "left", "right")
    )


def _basket_numbers(column: pa.ChunkedArray) -> np.ndarray:
    coded = column.combine_chunks().dictionary_encode()
    coded = coded if isinstance(coded, pa.Array) else pa.concat_arrays(coded.unify_dictionaries().chunks)
    return coded.indices.to_numpy().astype(np.int64)


def _later_pairs(baskets: DataFrame, n_items: int, min_support: int, most: int) -> DataFrame:
    """Pairs in at least ``min_support`` of the baskets, given as sorted arrays ``items``.

    Each item goes with the later ones of its basket to the task of its group,
    which counts their pairs by sorting them. An item with more than ``most``
    pairs is dealt to several tasks by basket, whose counts are added.
    """
    placed = baskets.select("basket_id", "items", F.posexplode("items").alias("pos", "i1")).withColumn(
        "later", F.size("items") - F.col("pos") - 1
    ).where("later > 0")
    pairs = stage(placed.groupBy("i1").agg(F.sum("later").alias("pairs")), "pairs-of-items")
    total = pairs.agg(F.sum("pairs")).first()[0] or 0
    hot = stage(pairs.where(F.col("pairs") > most).select("i1", F.ceil(F.col("pairs") / most).cast("int").alias("splits")), "hot-items")
    groups = total // most + 1
    tasks = groups + (hot.agg(F.sum("splits")).first()[0] or 0)
    sent = placed.join(hot, "i1", "left").select(
        F.pmod(F.xxhash64("i1"), F.lit(groups)).cast("int").alias("group"),
        F.pmod(F.xxhash64("basket_id"), F.coalesce("splits", F.lit(1))).cast("int").alias("split"),
        F.col("splits").isNull().alias("whole"), "i1", F.slice("items", F.col("pos") + 2, F.col("later")).alias("others"),
    ).repartition(tasks, "group", "split")

    def count(table: pa.Table) -> pa.Table:
        others, n = _flat(table.column("others"))
        i1, whole = table.column("i1").to_numpy().astype(np.int64), table.column("whole").to_numpy()
        keys = np.repeat(i1, n) * n_items + others
        keys.sort()
        firsts = np.flatnonzero(np.diff(keys, prepend=-1))
        counts, keys = np.diff(np.append(firsts, len(keys))), keys[firsts]
        known = np.isin(keys // n_items, i1[whole])
        often = (counts >= min_support) | ~known
        keys, counts, known = keys[often], counts[often], known[often]
        return pa.table({
            "i1": pa.array((keys // n_items).astype(np.int32)), "i2": pa.array((keys % n_items).astype(np.int32)),
            "support": pa.array(counts.astype(np.int64)), "whole": pa.array(known),
        })

    found = sent.groupBy("group", "split").applyInArrow(count, "i1 int, i2 int, support bigint, whole boolean")
    if hot.isEmpty():
        return found.select("i1", "i2", "support")
    found = stage(found, "pair-counts")
    added = found.where("NOT whole").groupBy("i1", "i2").agg(F.sum("support").alias("support"))
    return found.where("whole").select("i1", "i2", "support").union(added.where(F.col("support") >= min_support))


def pair_supports(
    coded: DataFrame, n_items: int, min_support: int, block_items: int = BLOCK_ITEMS, entries: int = ENTRIES,
    pairs_of_cell: int = PAIRS_OF_CELL, small_basket: int = SMALL_BASKET, pairs_at_once: int = PAIRS,
) -> DataFrame:
    """``i1 < i2`` and ``support`` of all pairs in at least ``min_support`` baskets.

    Baskets are cut into cells of blocks of items. Where these hold fewer than
    ``pairs_of_cell`` pairs on average, as with many items and small baskets,
    only baskets with more than ``small_basket`` items go by cells.
    """
    width = min(block_items, max(n_items, 1))
    if n_items <= width:
        return _pairs_in_cells(coded, n_items, min_support, block_items, entries)
    block = F.floor(F.col("code") / width).cast("int")
    by_basket = dealt(coded, coded.count(), "basket_id").groupBy("basket_id")
    sizes = stage(by_basket.agg(F.count("*").alias("n"), F.size(F.collect_set(block)).alias("blocks")), "basket-sizes")
    pairs, cells, largest = sizes.agg(
        F.sum(F.expr("n * (n - 1) / 2")), F.sum(F.expr("blocks * (blocks + 1) / 2")), F.max("n")
    ).first()
    if (pairs or 0) >= pairs_of_cell * (cells or 0):
        return _pairs_in_cells(coded, n_items, min_support, block_items, entries)
    small = coded
    if largest > small_basket:
        large = stage(sizes.where(F.col("n") > small_basket).select("basket_id"), "large-baskets")
        small = coded.join(large, "basket_id", "left_anti")
    arrays = dealt(small, coded.count(), "basket_id").groupBy("basket_id").agg(F.sort_array(F.collect_list("code")).alias("items"))
    arrays = stage(arrays, "small-baskets")
    if largest <= small_basket:
        return _later_pairs(arrays, n_items, min_support, pairs_at_once)
    every = _later_pairs(arrays, n_items, 1, pairs_at_once).union(
        _pairs_in_cells(coded.join(large, "basket_id", "left_semi"), n_items, 1, block_items, entries)
    )
    return every.groupBy("i1", "i2").agg(F.sum("support").alias("support")).where(F.col("support") >= min_support)


def _pairs_in_cells(
    coded: DataFrame, n_items: int, min_support: int, block_items: int, entries: int
) -> DataFrame:
    """``pair_supports`` by cells of two blocks of items.

    Items of one block need no cells: rows are dealt by basket as they are. A
    cell with more than ``entries`` entries is dealt to several tasks by
    basket, and their matrices are added row by row. What leaves a task is
    bounded by the size of its matrix, however many pairs its baskets hold.
    """
    width = min(block_items, max(n_items, 1))
    most = max(entries, width * width // 4)

    def matrix_rows(counts: np.ndarray, lo: int, hi: int, whole: bool) -> pa.Table:
        if lo == hi:
            counts = np.triu(counts, 1)
        a, b = np.nonzero(counts >= (min_support if whole else 1))
        firsts = np.flatnonzero(np.diff(a, prepend=-1))
        ends = np.append(firsts, len(a)).astype(np.int32)
        return pa.table({
            "i1": pa.array((lo * width + a[firsts]).astype(np.int32)), "hi": pa.array(np.full(len(firsts), hi, dtype=np.int32)),
            "whole": pa.array(np.full(len(firsts), whole)),
            "others": pa.ListArray.from_arrays(pa.array(ends), pa.array((hi * width + b).astype(np.int32))),
            "counts": pa.ListArray.from_arrays(pa.array(ends), pa.array(counts[a, b])),
        })

    if n_items <= width:
        splits = max(1, math.ceil(coded.count() / most))

        def count(table: pa.Table) -> pa.Table:
            baskets, items = _basket_numbers(table.column("basket_id")), table.column("code").to_numpy().astype(np.int64)
            items = items[np.argsort(baskets, kind="stable")]
            sizes = np.bincount(baskets)
            return matrix_rows(count_cell(items, sizes, items, sizes, width), 0, 0, splits == 1)

        split = F.pmod(F.xxhash64("basket_id"), F.lit(splits)).cast("int")
        groups = coded.select(split.alias("split"), "basket_id", "code").repartition(splits, "split").groupBy("split")
    else:
        item = F.col("code")
        blocks = stage(
            coded.groupBy("basket_id", F.floor(item / width).cast("int").alias("block")).agg(
                F.collect_list((item % width).cast("int")).alias("items")
            ), "item-blocks",
        )
        cells = stage(_cells(blocks), "block-cells")
        held = F.sum(F.size("left") + F.size("right")) / (2 * most)
        sizes = stage(cells.groupBy("lo", "hi").agg(F.ceil(held).cast("int").alias("splits")), "cell-sizes")
        split = F.pmod(F.xxhash64("basket_id"), F.col("splits")).cast("int")
        split_cells = cells.join(sizes, ["lo", "hi"]).select("lo", "hi", split.alias("split"), "splits", "left", "right")

        def count(table: pa.Table) -> pa.Table:
            lo, hi, splits = (table.column(c)[0].as_py() for c in ("lo", "hi", "splits"))
            counts = count_cell(*_flat(table.column("left")), *_flat(table.column("right")), width)
            return matrix_rows(counts, lo, hi, splits == 1)

        groups = split_cells.groupBy("lo", "hi", "split")

    def add(table: pa.Table) -> pa.Table:
        i1, hi = table.column("i1")[0].as_py(), table.column("hi")[0].as_py()
        others, counts = _flat(table.column("others"))[0], _flat(table.column("counts"))[0]
        total = np.zeros(width, dtype=np.int64)
        np.add.at(total, others - hi * width, counts)
        often = np.flatnonzero(total >= min_support)
        return pa.table({
            "i1": pa.array(np.full(len(often), i1, dtype=np.int32)), "i2": pa.array((hi * width + often).astype(np.int32)),
            "support": pa.array(total[often]),
        })

    found = stage(
        groups.applyInArrow(count, "i1 int, hi int, whole boolean, others array<int>, counts array<bigint>"), "cell-counts"
    )
    whole = found.where("whole").select("i1", F.explode(F.arrays_zip("others", "counts")).alias("pair")).select(
        "i1", F.col("pair.others").alias("i2"), F.col("pair.counts").alias("support")
    )
    parts = found.where("NOT whole").groupBy("i1", "hi").applyInArrow(add, "i1 int, i2 int, support bigint")
    return whole.union(parts)


def set_supports(
    coded: DataFrame, candidates: DataFrame, names: list[str], min_support: int, entries: int = ENTRIES,
    at_once: int = CANDIDATES,
) -> DataFrame:
    """``names`` (codes) and ``support`` of the candidates in at least ``min_support`` baskets.

    Candidates are cut into chunks by all items but the last, and baskets into
    parts by their id; every chunk meets every part of the rows of its items
    (a single chunk those of all items).
    """
    chunks = max(1, math.ceil(candidates.count() / at_once))
    split = F.pmod(F.xxhash64("basket_id"), F.col("splits")).cast("int")
    if chunks == 1:
        cells = max(1, math.ceil(coded.count() / entries))
        splits = F.lit(cells).cast("int")
        left = coded.select(F.lit(0).alias("chunk"), splits.alias("splits"), "basket_id", "code")
        right = candidates.select(F.lit(0).alias("chunk"), splits.alias("splits"), *names)
    else:
        chunk = F.pmod(F.xxhash64(*names[:-1]), F.lit(chunks)).cast("int")
        sets = stage(candidates.withColumn("chunk", chunk), "candidate-chunks")
        items = sets.select("chunk", F.explode(F.array(*names)).alias("code")).distinct()
        rows = stage(coded.join(items, "code").select("chunk", "basket_id", "code"), "chunk-rows")
        sizes = stage(
            rows.groupBy("chunk").agg(F.ceil(F.count("*") / entries).cast("int").alias("splits")), "chunk-sizes"
        )
        cells = sizes.agg(F.sum("splits")).first()[0] or 1
        left, right = rows.join(sizes, "chunk"), sets.join(sizes, "chunk")
    left = left.select("chunk", split.alias("split"), "basket_id", "code")
    right = right.withColumn("split", F.explode(F.expr("sequence(0, splits - 1)")))

    def count(rows: pa.Table, sets: pa.Table) -> pa.Table:
        columns = {name: sets.column(name).to_numpy() for name in names}
        supports = np.zeros(sets.num_rows, dtype=np.int64)
        if rows.num_rows and sets.num_rows:
            found = np.stack(list(columns.values()), axis=1)
            supports = count_sets(_basket_numbers(rows.column("basket_id")), rows.column("code").to_numpy(), found)
        least = min_support if sets.num_rows and sets.column("splits")[0].as_py() == 1 else 1
        often = np.flatnonzero(supports >= least)
        return pa.table({**{n: pa.array(c[often]) for n, c in columns.items()}, "n": pa.array(supports[often])})

    schema = ", ".join(f"{n} int" for n in names) + ", n bigint"
    # a task takes few cells, whatever number of shuffle partitions the session has
    left, right = (rows.repartition(cells, "chunk", "split") for rows in (left, right))
    counted = left.groupBy("chunk", "split").cogroup(right.groupBy("chunk", "split")).applyInArrow(count, schema)
    return counted.groupBy(*names).agg(F.sum("n").alias("support")).where(F.col("support") >= min_support)


ship_with_jobs(__name__)
