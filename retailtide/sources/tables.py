"""Stored tables, read with a predicate that reaches the storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_table(
    spark: SparkSession, url: str, table: str, split_by: str, lower, upper, tasks: int, **options
) -> DataFrame:
    """A database table read by ``tasks`` parallel range queries on ``split_by``.

    Filters and column choices made on the result are sent to the database.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    return reader.options(
        partitionColumn=split_by, lowerBound=lower, upperBound=upper, numPartitions=tasks
    ).load()


def on_day(table: DataFrame, column: str, day: str | dt.date) -> DataFrame:
    """Rows of one day of a date or timestamp column.

    On a timestamp Catalyst rewrites the cast to a range, so the scan skips row
    groups; on a partition column whole folders are skipped.
    """
    return table.filter(F.col(column).cast("date") == F.lit(str(day)).cast("date"))
