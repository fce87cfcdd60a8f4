"""The dashboard's numbers of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import METRICS, money, previous_day
from .visits import device_days


def all_hours(spark: SparkSession) -> DataFrame:
    """'00' to '23'."""
    return spark.range(0, 24, 1, 1).select(
        F.lpad(F.col("id").cast("string"), 2, "0").alias("hour")
    )


def fill_hours(by_hour: DataFrame, *measures: str) -> DataFrame:
    """All 24 hours, absent ones with 0."""
    hours = all_hours(by_hour.sparkSession)
    filled = hours.join(by_hour, "hour", "left")
    return filled.select("hour", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


def _two_days(rows: DataFrame, date: str, hour: str, day: str, measure) -> DataFrame:
    today, yesterday = F.try_to_date(F.lit(day), "yyyy-M-d"), previous_day(F.lit(day))
    on = F.col(date).try_cast("date")
    by_hour = (
        # one scan of both days, one conditional sum per series
        rows.filter((on == today) | (on == yesterday))
        .groupBy(F.col(hour).alias("hour"))
        .agg(measure(on == today).alias("today"), measure(on == yesterday).alias("yesterday"))
    )
    return fill_hours(by_hour, "today", "yesterday")


def compare_visits(visits: DataFrame, day: str) -> DataFrame:
    """Visitors by hour, ``day`` against the day before."""
    return _two_days(visits, "log_date", "log_hour", day, F.count_if)


def compare_orders(orders: DataFrame, day: str) -> DataFrame:
    """Sales by hour, ``day`` against the day before."""

    def amount(test: Column) -> Column:
        return F.sum(F.when(test, money(F.col("total_amount")))).cast("double")

    return _two_days(orders, "create_date", "create_hour", day, amount)


def compare_hours(metric: str, visits: DataFrame, orders: DataFrame, day: str) -> DataFrame | None:
    """The comparison asked for by its metric id; None for an unknown one."""
    if metric == "dau":
        return compare_visits(visits, day)
    if metric == "order_amount":
        return compare_orders(orders, day)
    return None


def hour_maps(compared: DataFrame) -> DataFrame:
    """The 24 rows of a comparison as one row of two maps, hour to value."""

    def by_hour(series: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.struct("hour", series)))
        return F.map_from_entries(pairs).alias(series)

    return compared.agg(by_hour("today"), by_hour("yesterday"))


def day_totals(visits: DataFrame, orders: DataFrame, day: str, new: DataFrame | None = None) -> DataFrame:
    """(id, name, value): visitors, new devices and sales of a day.

    ``new`` has a row per new device of the day; without it the first days come from all visits.
    """
    date = F.lit(day).cast("date")
    if new is None:
        devices = device_days(visits, date).agg(
            F.count_if("on_day").cast("double").alias("dau"),
            F.count_if(F.col("first_date") == date).cast("double").alias("new_mid"),
        )
    else:
        # two counts of one day each, laid over one another
        seen = visits.filter(F.col("log_date") == date).select("mid").distinct()
        both = seen.select(F.lit(1.0).alias("dau")).unionByName(new.select(F.lit(1.0).alias("new_mid")), True)
        devices = both.agg(*[F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in ("dau", "new_mid")])
    amount = orders.filter(F.col("create_date").try_cast("date") == date).agg(
        F.sum(money(F.col("total_amount"))).cast("double").alias("order_amount")
    )

    def rows(frame: DataFrame, *ids: str) -> DataFrame:
        entries = [
            F.struct(F.lit(i).alias("id"), F.lit(METRICS[i]).alias("name"), F.col(i).alias("value"))
            for i in ids
        ]
        return frame.select(F.inline(F.array(*entries)))

    return rows(devices, "dau", "new_mid").unionByName(rows(amount, "order_amount"))
