"""The user dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .latest import latest_by_key


def latest_users(feed: DataFrame, version: Sequence[str]) -> DataFrame:
    """Latest record per user id out of all inserts and updates."""
    return latest_by_key(feed, ["id"], version)
