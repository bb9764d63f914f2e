"""Who listens to what: counts per listener and per song.

Distinct counts group by (key, value) before they group by key, so one very
active listener or very popular song is reduced in many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.ratings import counted_plays


def distinct_users(plays: DataFrame) -> DataFrame:
    return plays.agg(F.count_distinct("user_id").alias("users"))


def distinct_items(plays: DataFrame, item: str = "song_id") -> DataFrame:
    return plays.select(item).distinct()


def user_activity(plays: DataFrame, ordered: bool = False) -> DataFrame:
    """Total plays and distinct songs per listener; ordered by distinct songs, fewest first."""
    activity = plays.groupBy("user_id").agg(
        F.sum("play_count").alias("total_plays"),
        F.count_distinct("song_id").alias("distinct_songs"),
    )
    return activity.orderBy("distinct_songs", "user_id") if ordered else activity


def item_popularity(plays: DataFrame, ordered: bool = False) -> DataFrame:
    """Total plays and distinct listeners per song; ordered by listeners, most first."""
    popularity = plays.groupBy("song_id").agg(
        F.sum("play_count").alias("total_plays"),
        F.count_distinct("user_id").alias("distinct_users"),
    )
    return popularity.orderBy(F.desc("distinct_users"), "song_id") if ordered else popularity


def distinct_sketches(plays: DataFrame, key: str, value: str, lg_k: int = 12) -> DataFrame:
    """A mergeable sketch per ``key`` of its distinct ``value``s, as ``sketch``.

    A sketch has at most about ``2 ** lg_k`` bytes whatever it has seen, so
    counts of a day can be stored and added up over days without the plays.
    """
    return plays.groupBy(key).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, key: str) -> DataFrame:
    """One sketch per ``key`` of all values that any of its sketches has seen."""
    return sketches.groupBy(key).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_distinct(sketches: DataFrame, key: str, name: str = "estimate") -> DataFrame:
    """Estimated number of distinct values per ``key``; the standard error is about ``1.04 / sqrt(2 ** lg_k)``."""
    return sketches.select(key, F.hll_sketch_estimate("sketch").alias(name))


def popular_items(plays: DataFrame, min_users: int = 900) -> DataFrame:
    """Songs with more than ``min_users`` distinct listeners."""
    return item_popularity(plays).where(F.col("distinct_users") > min_users)


def plays_per_song(plays: DataFrame, ordered: bool = False) -> DataFrame:
    """Plays per distinct song of each listener; ordered lowest first."""
    rate = user_activity(plays).select(
        "user_id", (F.col("total_plays") / F.col("distinct_songs")).alias("plays_per_song")
    )
    return rate.orderBy("plays_per_song", "user_id") if ordered else rate


def active_users(user_tracks: DataFrame, min_tracks: int) -> DataFrame:
    """Listeners with at least ``min_tracks`` rows."""
    counts = user_tracks.groupBy("user_id").agg(F.count("*").alias("tracks"))
    return counts.where(F.col("tracks") >= min_tracks)


def first_users(user_tracks: DataFrame, min_tracks: int, n: int, line: str = "line") -> DataFrame:
    """The first ``n`` listeners, in order of their first line, with at least ``min_tracks`` rows."""
    counts = user_tracks.groupBy("user_id").agg(
        F.count("*").alias("tracks"), F.min(line).alias("_first")
    )
    return counts.where(F.col("tracks") >= min_tracks).orderBy("_first").limit(n).drop("_first")


def resolved_users(user_paths: DataFrame) -> DataFrame:
    """Number of listeners with at least one track that has a path."""
    return user_paths.agg(F.count_distinct("user_id").alias("users"))


def for_user(df: DataFrame, user_id) -> DataFrame:
    """Rows of one listener; an unknown listener gives no rows."""
    return df.where(F.col("user_id") == F.lit(user_id))


def funnel_counts(plays: DataFrame, min_item_users: int = 10, min_user_songs: int = 5) -> DataFrame:
    """Row counts along the filters of ``counted_plays``: lines, songs kept, listeners kept, lines kept."""
    return counted_plays(plays, min_item_users, min_user_songs)[1]
