"""Orders: enrichment, sums, first orders, provinces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import created_date, created_hour, mask_phone, money
from .latest import first_by_key

# Where the map's colour steps begin; the last one has no end.
BIN_EDGES = (0, 100, 200, 300, 400, 500)


def enrich_orders(orders: DataFrame) -> DataFrame:
    """Add the creation date and hour, mask the telephone number."""
    return (
        orders.withColumn("create_date", created_date(F.col("create_time")))
        .withColumn("create_hour", created_hour(F.col("create_time")))
        .withColumn("consignee_tel", mask_phone(F.col("consignee_tel")))
    )


def order_amount(orders: DataFrame, day: str) -> DataFrame:
    """Sales of a day; null on a day without orders."""
    total = F.sum(money(F.col("total_amount"))).cast("double")
    return orders.filter(F.col("create_date") == day).agg(total.alias("total_amount"))


def order_amount_by_hour(orders: DataFrame, day: str) -> DataFrame:
    """Sales of a day by hour."""
    total = F.sum(money(F.col("total_amount"))).cast("double")
    return (
        orders.filter(F.col("create_date") == day)
        .groupBy("create_hour")
        .agg(total.alias("total_amount"))
    )


def with_first_order_flag(orders: DataFrame) -> DataFrame:
    """Add ``is_first_order``: 1 on each user's earliest order, else 0.

    The earliest order per user is found with a map-side limit; the flag returns
    to the orders on their own unique id. No step gathers a user's orders, so a
    user with very many costs nothing extra. Orders without a user get 0.
    """
    named = orders.filter(F.col("user_id").isNotNull())
    firsts = first_by_key(
        named.select("id", "user_id", "create_time"),
        ["user_id"],
        [F.col("create_time").asc_nulls_last(), F.col("id")],
    ).select("id", F.lit(1).alias("is_first_order"))
    flagged = orders.join(firsts, "id", "left")
    return flagged.withColumn("is_first_order", F.coalesce("is_first_order", F.lit(0)))


def sales_by_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Orders and amount per province, with the map's colour step.

    Grouped by id first, so only one row per province meets the name table.
    """
    grouped = orders.groupBy("province_id").agg(
        F.count("*").alias("orders"),
        F.sum(money(F.col("total_amount"))).cast("double").alias("amount"),
    )
    return grouped.join(provinces, "province_id", "left").select(
        "province_id", "province", "orders", "amount", colour_bin(F.col("orders")).alias("bin")
    )


def colour_bin(count: Column, edges: Sequence[int] = BIN_EDGES) -> Column:
    """Step of the map's scale: the number of the last edge not above ``count``."""
    steps = F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge <= count))
    return (steps - 1).cast("int")
