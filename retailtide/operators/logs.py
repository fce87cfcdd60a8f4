"""The collector's work on raw app logs: stamp, archive key, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import event_time, last_values, log_date, once, stamp_arrival


def stamp(raw: DataFrame, arrival_ms: Column | None = None) -> DataFrame:
    """Set ``ts`` in the JSON ``value`` to the arrival time in milliseconds.

    Pass the broker's time as ``arrival_ms`` where there is one: it stays the
    same when a batch is run again, the clock does not. Adds ``ts``. The record
    is opened as a map of variants, so all keys and their types survive; of a
    repeated key the last value stays. Of a text that is no JSON object ``value`` is null.
    """
    return stamp_or_keep(raw, arrival_ms).drop("text")


def stamp_or_keep(raw: DataFrame, arrival_ms: Column | None = None) -> DataFrame:
    """:func:`stamp`, with the raw text beside it as ``text``."""
    ms = stamp_arrival() if arrival_ms is None else arrival_ms
    entries = F.map_entries(F.from_json("value", "map<string,variant>"))
    stamp_entry = F.array(F.struct(F.lit("ts").alias("key"), ms.cast("variant").alias("value")))
    stamped = last_values(F.concat(F.filter(entries, lambda e: e["key"] != "ts"), stamp_entry))
    rest = [name for name in raw.columns if name not in ("value", "ts")]
    return raw.select(*rest, ms.alias("ts"), F.col("value").alias("text"), once(F.to_json(stamped)).alias("value"))


def dead_letter(source: str, reason: Column, text: Column) -> Column:
    """The JSON record of a raw text that cannot be used; a missing text has no ``value``."""
    return F.to_json(F.struct(F.lit(source).alias("source"), reason.alias("reason"), text.alias("value")))


def with_archive_day(stamped: DataFrame) -> DataFrame:
    """Add the day folder of the archive."""
    return stamped.withColumn("log_date", log_date(event_time(F.col("ts"))))


def route_logs(raw: DataFrame) -> DataFrame:
    """Add ``topic``: start-up records to one topic, all others, also those
    without a type, to the event topic."""
    kind = F.get_json_object("value", "$.type")
    return raw.withColumn("topic", F.when(kind == "startup", "startup").otherwise("event"))
