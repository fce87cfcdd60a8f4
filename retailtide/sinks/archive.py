"""Append-only archive of every stamped record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def archive_by_day(stamped: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Text lines under one folder per day; ``stamped`` has (log_date, value)."""
    return (
        stamped.select("log_date", "value")
        .writeStream.format("text")
        .partitionBy("log_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
