"""Listener profiles: tracks, features, label, and a model per listener with its error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from earshot.operators.features import (
    PROFILE_FEATURES, label_and_impute, user_features, user_play_counts,
)
from earshot.operators.ordering import positional_split
from earshot.operators.regression import fit_ols, mse, predict_linear
from earshot.session import stage


def user_profile(
    plays: DataFrame, song_tracks: DataFrame, track_paths: DataFrame, songs: DataFrame,
    features: Sequence[str] = tuple(PROFILE_FEATURES), line: str = "line",
) -> DataFrame:
    """One row per listener and track, with play count, scaled label and imputed features.

    The rows come from several joins and are compared with statistics of their
    listener, so they are staged once.
    """
    counts = user_play_counts(plays, song_tracks, track_paths, line).drop(line)
    rows = stage(user_features(counts, songs.select("track_id", *features)), "profile-rows")
    return label_and_impute(rows, features)


def profile_errors(
    profile: DataFrame, features: Sequence[str] = tuple(PROFILE_FEATURES), n_train: int = 21
) -> DataFrame:
    """Fit on each listener's first rows, test on the others: ``(user_id, n, mse, rmse)``.

    Of the profile only what orders the rows and what models are made of is read.
    """
    rows = profile.select("user_id", "song_id", "label", *features)
    split = stage(positional_split(rows, n_train), "profile")
    models = fit_ols(split.where("is_train"), features)
    return mse(predict_linear(models, split.where("NOT is_train"), features), by="user_id")
