"""Mixing sources to target weights by whole documents.

Documents get hash-random keys and are ordered by key within their source. A
prefix sum over that order, first over ranges of keys and then within each
range, says where a source's budget is reached; a budget beyond the size of
the source goes round again in the same order.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import TAG, numbered, tagged, untagged, word_count
from earshot.session import stage

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST_EPOCHS = 2
KEY_DIGITS = 3
_SOURCE = ["unnamed", "source"]


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: Fraction = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row per source with ``unnamed``, ``source``, ``source_size``.

    Weights repeat in the order of the sources. A target stops at ``most``
    times its source's size, and what is over goes to the others by weight:
    with the sources in the order of cap by weight, the common level is the
    largest of (total - caps before) / (weights from here on).
    """
    place = F.row_number().over(Window.orderBy(*_SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    all_rows = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), *_SOURCE)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(all_rows) * share.numerator / share.denominator
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    return (
        sizes.withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(all_rows))
        .select(
            *_SOURCE, "source_size",
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights=WEIGHTS, share: Fraction = SHARE, most: int = MOST_EPOCHS, key_digits: int = KEY_DIGITS,
    has_tags: bool = False,
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns ``row_tag``, ``doc_id``, ``size`` (words), ``source_size``,
    ``target``, ``epochs`` and ``taken`` (``epochs`` times ``size``). The key
    is the MD5 of the id, ties go by id and row. The document at a cut is
    taken if its middle lies within the budget, so a source misses its target
    by half a document at most. Null sources form one source; null and empty
    texts have size 0 and are taken in whole rounds only. ``16 ** key_digits``
    ranges of keys per source bound what one task sorts.
    """
    source = docs if has_tags else numbered(docs.select(id_column, text_column, source_column))
    name = F.col(source_column).cast("string")
    key = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    rows = stage(
        source.select(
            TAG, F.col(id_column).alias("doc_id"), name.isNull().alias("unnamed"),
            F.coalesce(name, F.lit("")).alias("source"), word_count(F.col(text_column)).alias("size"),
            key.alias("key"), F.substring(key, 1, key_digits).alias("range"),
        ),
        "mix-rows",
    )
    ranges = stage(rows.groupBy(*_SOURCE, "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    sizes = ranges.groupBy(*_SOURCE).agg(F.sum("range_size").alias("source_size"))
    in_source = Window.partitionBy(*_SOURCE).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranges.select(
        *_SOURCE, "range", F.coalesce(F.sum("range_size").over(in_source), F.lit(0)).alias("ahead")
    )
    in_range = (
        Window.partitionBy(*_SOURCE, "range").orderBy("key", "doc_id", TAG)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rounds = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    middle = F.col("ahead") + F.col("within") + F.col("size") / 2
    return (
        rows.withColumn("within", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
        .join(ahead, [*_SOURCE, "range"])
        .join(source_targets(sizes, weights, share, most), _SOURCE)
        .withColumn("rounds", rounds)
        .withColumn("epochs", F.col("rounds") + F.when((F.col("size") > 0) & (middle <= rest), 1).otherwise(0))
        .select(
            TAG, "doc_id", "size", "source_size", "target", F.col("epochs").cast("bigint").alias("epochs"),
            (F.col("epochs") * F.col("size")).cast("bigint").alias("taken"),
        )
    )


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
          **options) -> DataFrame:
    """The rows of the mix with all columns of ``docs``, each as often as it is taken."""
    source = tagged(docs, "mix-docs")
    taken = mix(source, id_column, text_column, source_column, has_tags=True, **options).where("epochs > 0")
    times = taken.select(TAG, F.col("epochs").alias("row_epochs"))
    repeated = source.join(times, TAG).withColumn("row_epoch", F.explode(F.expr("sequence(1L, row_epochs)")))
    return untagged(repeated.drop("row_epochs", "row_epoch"), docs)
