"""Listening analytics and song recommendation on Spark DataFrames."""

from earshot.session import build_session, release_staged, stage

__all__ = ["build_session", "release_staged", "stage"]
