"""Daily visitors: the first start-up of each device on each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import event_time, log_date, log_hour
from .latest import first_by_key


def with_log_time(logs: DataFrame) -> DataFrame:
    """Add ``event_ts``, ``log_date`` and ``log_hour`` from the arrival stamp.

    A source that already carries ``event_ts`` keeps it.
    """
    if "event_ts" not in logs.columns:
        logs = logs.withColumn("event_ts", event_time(F.col("ts")))
    return logs.withColumn("log_date", log_date(F.col("event_ts"))).withColumn(
        "log_hour", log_hour(F.col("event_ts"))
    )


def first_visits(logs: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """The earliest log of each (mid, log_date), whole row.

    Keyed by the day of the event, so a device seen just before and just after
    midnight counts on both days.
    """
    order: list[Column] = [F.col("event_ts"), *[F.col(name) for name in tie_break]]
    return first_by_key(logs, ["mid", "log_date"], order)


def first_visit_times(logs: DataFrame) -> DataFrame:
    """(mid, log_date, event_ts, log_hour) of the first visits.

    The narrow form for counting: a minimum is a hash aggregate with a map-side
    step and needs no sort.
    """
    firsts = logs.groupBy("mid", "log_date").agg(F.min("event_ts").alias("event_ts"))
    return firsts.withColumn("log_hour", log_hour(F.col("event_ts")))


def unseen(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """Logs whose (mid, log_date) is not among ``seen``.

    No broadcast hint: the seen set grows with the data, so its measured size
    decides, and a hot device on the left is split by the skew join.
    """
    return logs.join(seen.select("mid", "log_date"), ["mid", "log_date"], "left_anti")


def visit_total(visits: DataFrame, day: Column) -> DataFrame:
    """Visitors of a day."""
    return visits.filter(F.col("log_date") == day).agg(F.count("*").alias("visitors"))


def visits_by_hour(visits: DataFrame, day: Column) -> DataFrame:
    """Visitors of a day by hour of their first visit."""
    return (
        visits.filter(F.col("log_date") == day)
        .groupBy("log_hour")
        .agg(F.count("*").alias("visitors"))
    )


def device_days(visits: DataFrame, day: Column) -> DataFrame:
    """One row per device seen up to ``day``: first day, and whether seen on it.

    Takes visits or raw logs alike. Both visitor numbers of a day come from this
    one aggregate, which the map side reduces to a row per device.
    """
    return (
        visits.filter(F.col("log_date") <= day)
        .groupBy("mid")
        .agg(
            F.min("log_date").alias("first_date"),
            F.max(F.col("log_date") == day).alias("on_day"),
        )
    )


def new_devices(visits: DataFrame, day: Column) -> DataFrame:
    """Devices whose first day ever is ``day``."""
    firsts = visits.filter(F.col("log_date") <= day).groupBy("mid").agg(
        F.min("log_date").alias("first_date")
    )
    return firsts.agg(F.count_if(F.col("first_date") == day).alias("new_devices"))
