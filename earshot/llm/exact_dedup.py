"""Exact deduplication by a merge tree over sorted runs of digests.

Every row falls in one of ``runs`` runs. A round merges ``fan`` runs of equal
rank into one: the exchange is keyed by (merged run, digest), so the runs meet
slice by slice and no task holds a whole run; each digest keeps its smallest
row and its count. The last round leaves one run over all rows. The answers
then go down the same tree, so that a digest shared by a third of all rows is
asked for once per run of each level and never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import SPACES, TAG, numbered, tagged, untagged
from earshot.session import stage

RUNS = 256
FAN = 16
# a digest is trusted together with the length and a second hash of the text
KEY = ["digest", "n_bytes", "second"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _parent(fan: int) -> Column:
    return F.floor(F.col("run") / fan).cast("bigint")


def duplicate_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", runs: int = RUNS, fan: int = FAN,
    has_tags: bool = False,
) -> DataFrame:
    """One row per row of ``docs``, told apart by its ``row_tag`` if it ``has_tags``.

    Returns ``row_tag``, ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256``. Of equal texts the row with the smallest id stays, null
    ids last; of rows repeated with their id exactly one is kept. Null, empty
    and blank texts are ordinary texts (null equals empty; blank is one space).
    An empty table gives no rows.
    """
    source = docs if has_tags else numbered(docs.select(id_column, text_column))
    text = normalised(F.col(text_column))
    rows = stage(
        source.select(
            TAG, F.col(id_column).alias("doc_id"), F.sha2(text, 256).alias("digest"),
            F.octet_length(text).cast("bigint").alias("n_bytes"), F.xxhash64(text).alias("second"),
            F.pmod(F.xxhash64(TAG), F.lit(runs)).alias("run"),
        ),
        "dedup-rows",
    )
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", TAG)
    level = rows.select("run", *KEY, first.alias("best"), F.lit(1).cast("bigint").alias("n"))
    levels = []
    width = runs
    while True:
        merged = level.groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        levels.append(stage(merged.sortWithinPartitions("run", *KEY), "dedup-runs"))
        if width <= 1:
            break
        width = -(-width // fan)
        level = levels[-1].withColumn("run", _parent(fan))
    answer = levels[-1].select("run", *KEY, "best", "n")
    for below in reversed(levels[:-1]):
        asked = below.select(F.col("run").alias("own"), _parent(fan).alias("run"), *KEY)
        answer = asked.join(answer, ["run", *KEY]).drop("run").withColumnRenamed("own", "run")
    return rows.join(answer, ["run", *KEY]).select(
        TAG, "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col(TAG) == F.col(f"best.{TAG}")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns kept."""
    source = tagged(docs, "dedup-docs")
    kept = duplicate_groups(source, id_column, text_column, has_tags=True, **options).where("kept").select(TAG)
    return untagged(source.join(kept, TAG, "left_semi"), docs)
