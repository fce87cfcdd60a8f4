"""Ingest jobs: raw log lines and change records to topics and the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.changes import ROUTES, flatten_or_reject
from ..operators.logs import dead_letter, route_logs, stamp, stamp_or_keep, with_archive_day
from ..schemas import BROKEN_TOPIC
from ..sources import open_changes


def log_archive_stream(raw: DataFrame, arrival_ms: Column | None = None) -> DataFrame:
    """(log_date, value) for :func:`retailtide.sinks.archive_by_day`.

    The archive holds log records only; texts that are none are dead letters of
    :func:`log_route_stream`.
    """
    stamped = stamp(raw, arrival_ms).filter(F.col("value").isNotNull())
    return with_archive_day(stamped).select("log_date", "value")


def log_route_stream(raw: DataFrame, arrival_ms: Column | None = None) -> DataFrame:
    """(topic, value) for the routed sinks, each text parsed once.

    Stamp with the broker's time to get the same records as the archive. A text that is no
    JSON object goes to ``BROKEN_TOPIC``, wrapped with its source and the reason.
    """
    routed = route_logs(stamp_or_keep(raw, arrival_ms))
    broken = F.col("value").isNull()
    topic = F.when(broken, F.lit(BROKEN_TOPIC)).otherwise(F.col("topic"))
    value = F.when(broken, dead_letter("raw_log", F.lit("broken"), F.col("text"))).otherwise(F.col("value"))
    return routed.select(topic.alias("topic"), value.alias("value"))


def change_stream(raw: DataFrame, routes: dict[tuple[str, str], str] = ROUTES) -> DataFrame:
    """(topic, value) of the change records in JSON ``value``, dead letters under ``BROKEN_TOPIC``."""
    opened, reason = open_changes(raw)
    return flatten_or_reject(opened, reason, routes)
