"""Joins of plays with song features, labels and imputation.

Per-listener statistics are grouped aggregates, stored and joined back: both
sides of that join are plain shuffles, which adaptive execution splits where a
listener has very many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.columns import file_stem
from earshot.operators.ordering import dedup
from earshot.session import stage

# The 14 numeric columns used for regression, and the first six, which must be present.
NUMERIC_FEATURES = [
    "artistfamilarity", "artistHotness", "songHotness", "songEnfOfFadeIn", "startFadeout",
    "energy", "loudness", "albumID", "danceability", "duration", "keySignatureConfidence",
    "tempo", "timeSignature", "timeSignatureConfidence",
]
REQUIRED_FEATURES = NUMERIC_FEATURES[:6]

# The columns of a listener profile that a model is fitted on.
PROFILE_FEATURES = [
    "artistFamiliarity", "artistHottness", "dancebility", "duration", "endOfFadeIn",
    "energy", "loudness", "tempo", "songHotness",
]


def numeric_features(
    features: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES), key: str = "songId"
) -> DataFrame:
    """The song id and the numeric features as doubles; text columns are dropped."""
    return features.select(F.col(key).alias("song_id"), *[F.col(c).cast("double").alias(c) for c in columns])


def drop_nan(df: DataFrame, columns: Sequence[str] = tuple(REQUIRED_FEATURES)) -> DataFrame:
    """Rows in which all of ``columns`` are present."""
    return df.dropna(subset=list(columns))


def resolve_tracks(plays: DataFrame, song_tracks: DataFrame) -> DataFrame:
    return plays.join(song_tracks, "song_id")


def resolve_paths(df: DataFrame, track_paths: DataFrame) -> DataFrame:
    return df.join(track_paths, "track_id")


def join_features(plays: DataFrame, features: DataFrame) -> DataFrame:
    return plays.join(features, "song_id")


def feature_pairs(user_tracks: DataFrame, songs: DataFrame, x: str, y: str) -> DataFrame:
    """Two features for every track row of the listeners, repeated rows kept."""
    return user_tracks.select("track_id").join(songs.select("track_id", x, y), "track_id").select(x, y)


def user_play_counts(
    plays: DataFrame, song_tracks: DataFrame, track_paths: DataFrame, line: str = "line"
) -> DataFrame:
    """``(user_id, path, play_count)``; of repeated (listener, path) rows the first line counts."""
    resolved = resolve_paths(resolve_tracks(plays, song_tracks), track_paths)
    rows = resolved.select("user_id", "path", "song_id", "track_id", "play_count", line)
    return dedup(rows, ["user_id", "path"], [line], keep="first")


def user_features(user_paths: DataFrame, songs: DataFrame, key: str = "track_id") -> DataFrame:
    """Song features for each track of each listener.

    ``user_paths`` is ``(user_id, paths)`` with an array of paths, or long rows
    that already have ``key``.
    """
    if "paths" in user_paths.columns:
        user_paths = user_paths.select("user_id", F.explode("paths").alias("path"))
        user_paths = user_paths.select("*", file_stem(F.col("path")).alias(key))
    return user_paths.join(songs, key)


def attach_play_count(features: DataFrame, counts: DataFrame) -> DataFrame:
    return features.join(counts.select("user_id", "track_id", "play_count"), ["user_id", "track_id"])


def _limits(column: str) -> list:
    return [F.min(column).alias("_low"), F.max(column).alias("_high")]


def _means(columns: Sequence[str]) -> list:
    return [F.avg(c).alias(f"_mean_{c}") for c in columns]


def _scaled_label(column: str):
    spread = F.col("_high") - F.col("_low")
    return F.when(spread == 0, F.lit(0.0)).otherwise((F.col(column) - F.col("_low")) / spread)


def _with_statistics(df: DataFrame, statistics: list, group: str, train: str | None) -> DataFrame:
    fitted = df.where(F.col(train)) if train else df
    return df.join(stage(fitted.groupBy(group).agg(*statistics), "group-statistics"), group)


def _filled(df: DataFrame, columns: Sequence[str]) -> list:
    filled = {c: F.coalesce(F.col(c), F.col(f"_mean_{c}"), F.lit(0.0)).alias(c) for c in columns}
    return [filled.get(c, F.col(c)) for c in df.columns]


def minmax_label(
    df: DataFrame, column: str = "play_count", group: str = "user_id", label: str = "label",
    train: str | None = None,
) -> DataFrame:
    """Scale ``column`` to 0…1 inside each group; a constant column gives 0.

    With ``train`` (a boolean column) the range is taken from those rows only.
    """
    joined = _with_statistics(df, _limits(column), group, train)
    return joined.select(*df.columns, _scaled_label(column).alias(label))


def impute_mean(
    df: DataFrame, columns: Sequence[str], group: str = "user_id", train: str | None = None
) -> DataFrame:
    """Missing values become the mean of their group, or 0 where the group has none."""
    return _with_statistics(df, _means(columns), group, train).select(*_filled(df, columns))


def label_and_impute(
    df: DataFrame, columns: Sequence[str], column: str = "play_count", group: str = "user_id", label: str = "label"
) -> DataFrame:
    """``minmax_label`` and ``impute_mean`` with one aggregate and one join."""
    joined = _with_statistics(df, [*_limits(column), *_means(columns)], group, None)
    return joined.select(*_filled(df, columns), _scaled_label(column).alias(label))
