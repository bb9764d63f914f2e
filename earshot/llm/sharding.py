"""Sharding by sampled splitters.

The sort key is a hash of the text, so equal texts are neighbours. A sample of
keys, drawn with weight by size, gives the quantiles that cut the key space
into ranges; ranges that turn out overfull are cut again. Texts that are heavy
in themselves (at most ``shards * HEAVY`` of them) are placed first, whole, and
only one larger than a shard is cut; the ranges then fill up the shards in key
order, so that all shards hold nearly the same number of bytes.
"""

from __future__ import annotations

import bisect
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import ship_with_jobs
from earshot.session import stage

SHARDS = 16
# ranges of keys per table, and texts of more than 1 / HEAVY of a shard count as heavy
RANGES = 2048
HEAVY = 50
SAMPLE = 40_000


def _splitters(groups: DataFrame, total: int, ranges: int, sample: int) -> list[int]:
    """Quantiles of a sample in which each byte has the same chance; at most ``ranges - 1``.

    The chance is drawn from a second hash of the key, so a rerun draws the same.
    """
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    drawn = groups.where(chance < F.col("bytes") * (sample / max(total, 1))).select("key").collect()
    keys = sorted(row.key for row in drawn)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _ranged(groups: DataFrame, splitters: list[int]) -> DataFrame:
    shared = groups.sparkSession.sparkContext.broadcast(np.array(splitters, dtype=np.int64))

    @F.pandas_udf("bigint")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, key.to_numpy(), side="right"))

    return groups.withColumn("unit", range_of("key"))


def _cut_overfull(groups: DataFrame, splitters: list[int], limit: int) -> list[int]:
    """Splitters that also cut ranges above ``limit`` bytes, until all fit or hold one text."""
    while True:
        counted = (
            _ranged(groups, splitters).groupBy("unit")
            .agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
            .orderBy("unit").collect()
        )
        new = set()
        for row in counted:
            pieces = min(ceil(row.bytes / limit), row.high - row.low)
            if row.bytes > limit and pieces > 0:
                new |= {row.low + max(1, (row.high - row.low) * i // (pieces + 1)) for i in range(1, pieces + 1)}
        if not new - set(splitters):
            return splitters
        splitters = sorted(new | set(splitters))


def _place(heavy: dict[int, list], light: list, total: int, shards: int) -> dict[int, int]:
    """The shard of each unit: heavy texts, largest first, to the emptiest shard; then the ranges in order.

    A heavy text comes as the units it was dealt into; it stays whole unless it
    is larger than a shard.
    """
    share = total / shards
    filled = [0] * shards
    home: dict[int, int] = {}
    for key in sorted(heavy, key=lambda k: (-sum(u.bytes for u in heavy[k]), k)):
        size = sum(u.bytes for u in heavy[key])
        pieces = max(1, ceil(size / share))
        done, piece, shard = 0, -1, 0
        for unit in heavy[key]:
            now = min(int((done + unit.bytes / 2) * pieces / size), pieces - 1)
            if now != piece:
                piece, shard = now, min(range(shards), key=lambda s: (filled[s], s))
            home[unit.unit] = shard
            filled[shard] += unit.bytes
            done += unit.bytes
    rooms = np.cumsum([max(0.0, share - x) for x in filled])
    scale = sum(u.bytes for u in light) / max(rooms[-1], 1.0)
    edges = [float(x) * scale for x in rooms]
    done = 0
    for unit in light:
        home[unit.unit] = min(bisect.bisect_left(edges, done + unit.bytes / 2), shards - 1)
        done += unit.bytes
    return home


def shard(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS, ranges: int = RANGES,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``text_crc32``, ``key``, ``shard``, ``slot``.

    ``size`` is the UTF-8 length plus 1. Null counts as the empty text. Slots
    of a shard run from 0 without gaps, in the order of its ranges, keys and
    ids. Equal texts share a shard unless they are larger than one. The driver
    holds a sample of about ``sample`` keys and one row per range and heavy
    text, all bounded by the parameters. A text is heavy by its bytes or its
    rows and is dealt into units by the row, so no unit is large. A very long
    text is a row like any other, repeated rows and ties are told apart by a
    tag, and other columns of ``docs`` are not read. An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_column).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("tag"),
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("n")).first()
    total, n_rows = total or 0, n_rows or 0
    # very short texts may be few bytes and yet many rows
    is_heavy = (F.col("bytes") > total / (shards * HEAVY)) | (F.col("n") > n_rows / (shards * HEAVY))
    heavy = groups.where(is_heavy).collect()
    light_groups = groups.where(~is_heavy)
    light_total = total - sum(r.bytes for r in heavy)
    limit = max(2 * light_total // ranges, 1)
    splitters = _cut_overfull(light_groups, _splitters(light_groups, light_total, ranges, sample), limit)

    # heavy texts become units of their own, dealt out by a hash of the row so that no unit is large
    first, starts, owner = len(splitters) + 1, [], {}
    for row in sorted(heavy, key=lambda r: r.key):
        parts = min(row.n, max(ceil(row.bytes * ranges / total), ceil(row.n * ranges / n_rows)))
        starts.append((row.key, first, parts))
        owner |= {first + i: row.key for i in range(parts)}
        first += parts
    heavy_units = spark.createDataFrame(starts, "key bigint, first bigint, parts bigint")
    spread = F.pmod(F.xxhash64("tag"), F.col("parts"))
    units = stage(
        _ranged(rows, splitters).join(F.broadcast(heavy_units), "key", "left")
        .withColumn("unit", F.coalesce(F.col("first") + spread, F.col("unit")))
        .drop("first", "parts"),
        "shard-units",
    )
    counted = units.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("unit").collect()
    dealt: dict[int, list] = {}
    for unit in counted:
        if unit.unit in owner:
            dealt.setdefault(owner[unit.unit], []).append(unit)
    home = _place(dealt, [u for u in counted if u.unit not in owner], total, shards)
    ahead = [0] * shards
    placed = []
    for unit in counted:
        placed.append((unit.unit, home[unit.unit], ahead[home[unit.unit]]))
        ahead[home[unit.unit]] += unit.n
    table = spark.createDataFrame(placed, "unit bigint, shard int, ahead bigint")
    place = F.row_number().over(Window.partitionBy("unit").orderBy("key", "doc_id", "tag")) - 1
    return (
        units.withColumn("place", place).join(F.broadcast(table), "unit")
        .select("doc_id", "size", "text_crc32", "key", "shard", (F.col("ahead") + F.col("place")).alias("slot"))
    )


ship_with_jobs(__name__)
