"""Groups of rows that meet in Python tasks, and connected components of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.session import ship_with_jobs, stage


def split_hot(rows: DataFrame, key: str, spread: str, cap: int) -> DataFrame:
    """Adds ``lo``, ``hi`` and ``own`` so that no group of (key, lo, hi) is much above twice ``cap`` rows.

    Groups of more than ``cap`` rows are dealt into blocks by a hash of
    ``spread``; a row goes to every pair of blocks with its own in it, so any
    two rows of a group still meet. They meet once where ``lo`` equals ``hi``
    or where their ``own`` differs.
    """
    counts = stage(rows.groupBy(key).agg(F.count("*").alias("size")).where(F.col("size") > cap), "hot-keys")
    none = F.lit(0).cast("int")
    if counts.isEmpty():
        return rows.select("*", none.alias("lo"), none.alias("hi"), none.alias("own"))
    blocks = F.ceil(F.coalesce(F.col("size"), F.lit(1)) / cap).cast("int")
    return (
        rows.join(counts, key, "left")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64(spread), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .drop("size", "blocks", "other")
    )


def over_groups(
    rows: DataFrame, keys: list[str], function: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Applies ``function`` to whole groups, many at a time.

    Rows are dealt and sorted by ``keys``. ``function`` gets a table of
    complete groups and the first row of each, with an end mark. Only the last
    group of a batch waits for the next batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if table.num_rows:
                changed = np.zeros(table.num_rows, dtype=bool)
                changed[0] = True
                for key in keys:
                    column = table.column(key).to_numpy()
                    changed[1:] |= column[1:] != column[:-1]
                result = function(table, np.append(np.flatnonzero(changed), table.num_rows))
                if result is not None and result.num_rows:
                    yield result

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            last = [table.column(key)[-1].as_py() for key in keys]
            same = np.ones(table.num_rows, dtype=bool)
            for key, value in zip(keys, last):
                same &= table.column(key).to_numpy() == value
            cut = table.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            if waiting and cut == 0 and [waiting[0].column(key)[0].as_py() for key in keys] == last:
                waiting.append(table)
                continue
            if cut == 0:
                yield from done(pa.concat_tables(waiting)) if waiting else ()
            else:
                yield from done(pa.concat_tables([*waiting, table.slice(0, cut)]))
            waiting = [table.slice(cut)]
        if waiting:
            yield from done(pa.concat_tables(waiting))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def roots_of_pairs(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position each of ``n`` positions is connected to by the pairs."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[left], roots[right])
        new = roots.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, roots[left], low)
        np.minimum.at(new, roots[right], low)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, of the links ``a``, ``b``.

    Alternates large and small stars: every node hands its neighbours on to
    the smallest of them, until nothing moves. The smallest neighbours are
    stored before they are joined back, so that a node with very many links is
    split among tasks. Nodes without links are not in the result.
    """

    def handed_on(links: DataFrame, only_larger: bool) -> DataFrame:
        """links: u, v. Every v goes to the smallest of u's neighbours and u."""
        low = F.min("v") if not only_larger else F.least(F.min("v"), F.first("u"))
        lowest = stage(links.groupBy("u").agg(low.alias("low")), "lowest")
        moved = links.join(lowest, "u")
        if only_larger:
            return moved.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        own = lowest.select("u", F.col("low").alias("v"))
        return moved.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).union(own)

    def settled(links: DataFrame) -> tuple[DataFrame, tuple]:
        stored = stage(links.where("u <> v").distinct(), "links")
        print_ = stored.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return stored, tuple(print_)

    links, before = settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = stage(handed_on(both, True).distinct(), "larger")
        links, after = settled(handed_on(larger, False))
        if after == before:
            break
        before = after
    tops = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        tops.select("node", F.col("node").alias("component"))
    )


ship_with_jobs(__name__)
