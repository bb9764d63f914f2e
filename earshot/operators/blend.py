"""Blended recommendation lists and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def blend(rule_recs: DataFrame, predictions: DataFrame, cap: int = 500) -> DataFrame:
    """Rule recommendations first, then predictions by score up to ``cap`` in all.

    ``rule_recs`` is ``(user_id, song_id)``, ``predictions`` adds ``score``. A
    song is listed once. Rules are never cut; predictions fill what is left.
    Each listener's predictions are cut to ``cap`` before the shuffle.
    """
    rules = rule_recs.select("user_id", "song_id").distinct()
    n_rules = rules.groupBy("user_id").agg(F.count("*").alias("n_rules"))
    by_score = W.partitionBy("user_id").orderBy(F.desc(F.round("score", 9)), "song_id")
    fresh = (
        predictions.join(rules, ["user_id", "song_id"], "left_anti")
        .select("user_id", "song_id", F.row_number().over(by_score).alias("place"))
        .where(F.col("place") <= cap)
        .join(n_rules, "user_id", "left")
        .select("user_id", "song_id", (F.col("place") + F.coalesce("n_rules", F.lit(0))).alias("place"))
        .where(F.col("place") <= cap)
        .select("user_id", "song_id", F.lit("prediction").alias("source"), F.col("place").cast("bigint").alias("place"))
    )
    in_order = F.row_number().over(W.partitionBy("user_id").orderBy("song_id"))
    first = rules.select(
        "user_id", "song_id", F.lit("rule").alias("source"), in_order.cast("bigint").alias("place")
    )
    return first.unionByName(fresh)


def hits(recommended: DataFrame, hidden: DataFrame) -> DataFrame:
    """Recommended songs that are among the hidden plays."""
    return recommended.select("user_id", "song_id").intersect(hidden.select("user_id", "song_id"))


def evaluate(recommended: DataFrame, hidden: DataFrame) -> DataFrame:
    """Hits, list sizes and precision per listener; without recommendations precision is NULL."""
    listed = recommended.select("user_id", "song_id").distinct().withColumn("r", F.lit(1))
    kept = hidden.select("user_id", "song_id").distinct().withColumn("h", F.lit(1))
    both = listed.join(kept, ["user_id", "song_id"], "full_outer")
    counts = both.groupBy("user_id").agg(
        F.count(F.when(F.col("r").isNotNull() & F.col("h").isNotNull(), 1)).alias("hits"),
        F.count("r").alias("recommended"),
        F.count("h").alias("hidden"),
    )
    return counts.select("*", (F.col("hits") / F.nullif("recommended", F.lit(0))).alias("precision"))
