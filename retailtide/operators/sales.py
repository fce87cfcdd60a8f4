"""Sale lines: orders with their details and the buyer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import age_years, price
from .latest import latest_by_key

# Fixed value: how long one side waits for the other, in seconds.
JOIN_LIFE_SECONDS = 3600

USER_COLUMNS = ("user_gender", "user_age", "user_level")


def details_with_orders_full(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Full outer join on the order id, ``order_id`` from whichever side has it.

    Built as "details with their order, if any" plus "orders without details":
    both joins can split a hot order, a full outer join cannot.
    """
    heads = orders.withColumnRenamed("id", "order_id")
    tails = details.withColumnRenamed("id", "order_detail_id")
    lines = tails.join(heads, "order_id", "left")
    with_lines = tails.groupBy("order_id").agg(F.lit(True).alias("_has_lines"))
    lonely = heads.join(with_lines, "order_id", "left_anti")
    return lines.unionByName(lonely, allowMissingColumns=True)


def within_life(order_ts: Column, detail_ts: Column, seconds: int = JOIN_LIFE_SECONDS) -> Column:
    """Both arrived within ``seconds`` of each other, in either order."""
    life = F.expr(f"interval {int(seconds)} seconds")
    return (detail_ts >= order_ts - life) & (detail_ts <= order_ts + life)


def merge_order_and_detail(
    orders: DataFrame, details: DataFrame, seconds: int = JOIN_LIFE_SECONDS, salts: int = 1
) -> DataFrame:
    """Each detail with its order when both arrived in time.

    ``orders`` are enriched and carry ``order_ts``, ``details`` carry
    ``detail_ts``. Sides that never meet are not emitted. ``salts`` spreads the
    details of one order over that many tasks and copies the order to each; a
    batch join needs none, since the skew join splits a hot order at run time.
    Buyer columns that the orders already have come along.
    """
    heads = orders.select(
        *[name for name in USER_COLUMNS if name in orders.columns],
        F.col("id").alias("order_id"),
        "order_status",
        "create_time",
        F.col("create_date").alias("dt"),
        "user_id",
        "order_ts",
    )
    tails = details.select(
        F.col("id").alias("order_detail_id"),
        F.col("order_id").alias("detail_order_id"),
        "sku_id",
        "sku_name",
        price(F.col("order_price")).alias("sku_price"),
        "detail_ts",
    )
    met = (F.col("order_id") == F.col("detail_order_id")) & within_life(
        F.col("order_ts"), F.col("detail_ts"), seconds
    )
    if salts > 1:
        heads = heads.withColumn("head_salt", F.explode(F.array(*map(F.lit, range(salts)))))
        spread = F.pmod(F.xxhash64("order_detail_id"), F.lit(salts)).cast("int")
        tails = tails.withColumn("tail_salt", spread)
        met = (F.col("head_salt") == F.col("tail_salt")) & met
    return heads.join(tails, met).drop("detail_order_id", "head_salt", "tail_salt")


def latest_lines(lines: DataFrame) -> DataFrame:
    """One row per detail id: repeated sends collapse to the last one."""
    version = [F.greatest("order_ts", "detail_ts").alias("_met_ts")]
    ordered = lines.select("*", *version)
    ranked = latest_by_key(
        ordered,
        ["order_detail_id"],
        ["_met_ts", "order_ts", "detail_ts", "sku_price", "order_status", "create_time"],
    )
    return ranked.drop("_met_ts")


def with_user(lines: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """Add the buyer's gender, age and level.

    An unknown buyer keeps the line, with age 0 and the rest null. The user table
    may be large, so its measured size decides how it is joined.
    """
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    known = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), day).alias("user_age"),
        "user_level",
    )
    joined = lines.join(known, "user_id", "left")
    return joined.withColumn("user_age", F.coalesce("user_age", F.lit(0)))


def sale_lines(
    orders: DataFrame,
    details: DataFrame,
    users: DataFrame,
    as_of: str | Column,
    seconds: int = JOIN_LIFE_SECONDS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The wide sale table, one row per order detail.

    The buyer is looked up per order, before there is a row per detail.
    """
    heads = with_user(orders, users, as_of)
    wide = latest_lines(merge_order_and_detail(heads, details, seconds))
    return wide.select(*columns) if columns else wide
