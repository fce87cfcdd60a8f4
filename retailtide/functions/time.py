"""Days, hours and ages. All of them are plain built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_time(ts_ms: Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(ts_ms)


def stamp_arrival() -> Column:
    """Server arrival time in epoch milliseconds."""
    return F.unix_millis(F.current_timestamp())


def arrival_time(ts_ntz: Column) -> Column:
    """A zone-less UTC time as the ``timestamp`` type that watermarks need."""
    return ts_ntz.cast("timestamp")


def log_date(ts: Column) -> Column:
    # A cast, not date_format: Catalyst turns "cast(ts as date) = d" into a range
    # on ts, which reaches the Parquet scan.
    return ts.cast("date")


def log_hour(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def created_date(create_time: Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` text; null when there is none."""
    return F.get(F.split(create_time, " "), F.lit(0))


def created_hour(create_time: Column) -> Column:
    """Hour part of the same text; null when there is no time of day."""
    return F.get(F.split(F.get(F.split(create_time, " "), F.lit(1)), ":"), F.lit(0))


def previous_day(day: Column) -> Column:
    """The day before a ``yyyy-MM-dd`` text; null when the text is no date."""
    return F.date_sub(F.try_to_date(day, "yyyy-M-d"), 1)


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days, so not the calendar age."""
    days = F.datediff(as_of, F.try_to_date(birthday, "yyyy-M-d"))
    # trunc toward zero; 365 is never 0, so no try_divide is needed
    return (days / F.lit(365)).cast("int")
