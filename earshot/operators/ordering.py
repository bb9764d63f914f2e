"""Order-dependent operators: ordered dedup, numbering, positional split, top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from earshot.session import stage


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first or the last by ``order``.

    An aggregate, not a window: each task first reduces its own rows, so a key
    with very many rows costs no more than others. Columns of ``order`` are
    taken from the best order, not carried beside it; where the caller drops
    them, rows go through the shuffle with them once.
    """
    pick, best = {"first": (F.min_by, F.min), "last": (F.max_by, F.max)}[keep]
    rest = [c for c in df.columns if c not in keys and c not in order]
    places = F.struct(*order)
    row = pick(F.struct(*rest) if rest else F.lit(0), places)
    found = df.groupBy(*keys).agg(row.alias("_row"), best(places).alias("_order"))
    return found.select(*[
        F.col(c) if c in keys else F.col(f"_order.{c}" if c in order else f"_row.{c}").alias(c) for c in df.columns
    ])


def number_rows(df: DataFrame, order: Sequence[str], name: str = "SongNumber") -> DataFrame:
    """Number all rows 1, 2, … by ``order`` without a one-task window.

    Rows are range-partitioned and sorted, and each takes its place inside its
    partition; the offsets come from one row per partition. The placed rows are
    staged, so that places and offsets are of the same partitioning.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), place.alias("_place"))
    )
    placed = stage(placed, "numbered")
    # one row per partition of the sort, so this window is small by construction
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    number = (F.col("_before") + F.col("_place") + 1).cast("bigint")
    return placed.join(offsets, "_part").select(number.alias(name), *df.columns)


def positional_split(
    df: DataFrame, n_train: int = 21, group: str = "user_id", order: str = "song_id"
) -> DataFrame:
    """Add ``is_train``: the first ``n_train`` rows of each group by ``order``.

    Only the boundary of each group is ranked, which Spark cuts to ``n_train``
    rows before the shuffle; all rows are then compared with their boundary.
    ``order`` must be unique inside a group.
    """
    place = F.row_number().over(W.partitionBy(group).orderBy(order))
    last = (
        df.select(group, order, place.alias("_place"))
        .where(F.col("_place") <= n_train)
        .groupBy(group)
        .agg(F.max(order).alias("_last"))
    )
    return df.join(stage(last, "boundaries"), group).select(*df.columns, (F.col(order) <= F.col("_last")).alias("is_train"))


def top(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` largest rows, comparing columns from left to right."""
    return df.orderBy(*[F.desc(c) for c in df.columns]).limit(n)


def head_lines(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in line order."""
    return df.orderBy(*order).limit(n)
