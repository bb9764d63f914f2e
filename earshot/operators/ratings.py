"""From play counts to mean-centred ratings.

Thresholds are grouped counts joined back by a semi-join, never windows over a
listener or a song: a count is reduced before the shuffle. The counts are
stored before the join, so that both of its sides are plain shuffles: only then
adaptive execution splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.columns import scale_rating
from earshot.session import dealt, stage


def min_item_support(plays: DataFrame, min_rows: int = 10) -> DataFrame:
    """Rows of songs that have at least ``min_rows`` rows."""
    kept = plays.groupBy("song_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)
    return plays.join(stage(kept, "songs-with-support"), "song_id", "left_semi")


def min_user_items(plays: DataFrame, min_rows: int = 5) -> DataFrame:
    """Rows of listeners that have at least ``min_rows`` rows."""
    kept = plays.groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)
    return plays.join(stage(kept, "active-users"), "user_id", "left_semi")


def qualified_plays(plays: DataFrame, min_item_users: int = 10, min_user_songs: int = 5) -> DataFrame:
    """The song threshold, then the listener threshold; songs are not checked again.

    ``plays`` is read several times: pass a stored table or a staged one.
    """
    return min_user_items(min_item_support(plays, min_item_users), min_user_songs)


def counted_plays(
    plays: DataFrame, min_item_users: int = 10, min_user_songs: int = 5
) -> tuple[DataFrame, DataFrame]:
    """``qualified_plays`` and, from the same run, ``(stage, n)`` along its filters.

    The stages are ``lines``, ``songs_kept``, ``users_kept`` and
    ``lines_kept``. They are read off the stored counts that the thresholds
    compare, so neither the plays nor the filters are evaluated for them.
    """
    songs = stage(plays.groupBy("song_id").agg(F.count("*").alias("n")), "song-counts")
    often = songs.where((F.col("n") >= min_item_users) & F.col("song_id").isNotNull())
    by_song = plays.join(often, "song_id", "left_semi")
    users = by_song.groupBy("user_id").agg(F.count("*").alias("n"))
    active = stage(users.where((F.col("n") >= min_user_songs) & F.col("user_id").isNotNull()), "active-users")
    kept = by_song.join(active, "user_id", "left_semi")

    def row(name: str, counts: DataFrame, value) -> DataFrame:
        return counts.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("n")).select(F.lit(name).alias("stage"), "n")

    funnel = (
        row("lines", songs, F.sum("n")).unionByName(row("songs_kept", often, F.count("*")))
        .unionByName(row("users_kept", active, F.count("*"))).unionByName(row("lines_kept", active, F.sum("n")))
    )
    return kept, funnel


def to_ratings(
    plays: DataFrame, scale: str = "log2", min_item_users: int = 10, min_user_songs: int = 5
) -> DataFrame:
    """``(user_id, song_id, rating)`` of the qualified plays.

    The thresholds count rows; plays of a listener and song in several rows are
    then added up to one rating.
    """
    kept = qualified_plays(plays, min_item_users, min_user_songs)
    kept = dealt(kept, plays.count(), "user_id", "song_id").groupBy("user_id", "song_id").agg(F.sum("play_count").alias("play_count"))
    return kept.select("user_id", "song_id", scale_rating(F.col("play_count"), scale).alias("rating"))


def rated_items(ratings: DataFrame, user_id) -> DataFrame:
    """Rows of the songs that one listener rated."""
    mine = ratings.where(F.col("user_id") == F.lit(user_id)).select("song_id")
    return ratings.join(mine, "song_id", "left_semi")


def candidate_items(ratings: DataFrame, user_id) -> DataFrame:
    """Rows of the songs that one listener has not rated."""
    mine = ratings.where(F.col("user_id") == F.lit(user_id)).select("song_id")
    return ratings.join(mine, "song_id", "left_anti")


def item_stats(ratings: DataFrame) -> DataFrame:
    """Mean and centred norm of each song in one aggregate.

    The norm comes from the population variance, which Spark merges stably. A
    song whose ratings are all equal has exactly norm 0.
    """
    n, variance = F.count("rating"), F.var_pop("rating")
    constant = F.min("rating") == F.max("rating")
    return ratings.groupBy("song_id").agg(
        F.avg("rating").alias("mean"),
        F.when(constant, F.lit(0.0)).otherwise(F.sqrt(variance * n)).alias("norm"),
    )


def _centered() -> Column:
    return F.when(F.col("norm") == 0, F.lit(0.0)).otherwise(F.col("rating") - F.col("mean"))


def center_by_item(ratings: DataFrame) -> DataFrame:
    """Add ``centered``, the rating less the mean rating of its song."""
    return ratings.join(stage(item_stats(ratings), "song-means"), "song_id").select(*ratings.columns, _centered().alias("centered"))


def item_norms(ratings: DataFrame) -> DataFrame:
    """Length of each song's centred row, over all its listeners."""
    return item_stats(ratings).select("song_id", "norm")


def unit_rows(ratings: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``(user_id, song_id, unit)``: centred rows scaled to length 1.

    The cosine of two songs is then the plain sum of products. Songs of norm 0
    have no direction and are left out. With ``rows`` only those of the ratings
    are given; means and norms are of all ratings either way.
    """
    stats = stage(item_stats(ratings).where(F.col("norm") > 0), "song-norms")
    return (ratings if rows is None else rows).join(stats, "song_id").select(
        "user_id", "song_id", ((F.col("rating") - F.col("mean")) / F.col("norm")).alias("unit")
    )
