"""The given tables mapped to the shop's record types (see FIXTURES.md).

All mappings are plain projections and equi-joins, so filters and column choices
made on an entity reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.visits import with_log_time
from ..session import use_utc
from ..sources import on_day, parquet_table

AS_OF = "2001-08-01"  # day on which ages are taken
EPOCH = "2024-01-01"  # first ingest time of the derived feeds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(use_utc(spark), sf_dir, name)


def text(name: str) -> Column:
    return F.col(name).cast("string")


def millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def item(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k")


def after_epoch(seconds: Column) -> Column:
    """``EPOCH`` plus whole seconds, as a timestamp."""
    return F.timestamp_seconds(F.unix_seconds(F.lit(EPOCH).cast("timestamp")) + seconds)


# ---- app logs ------------------------------------------------------------


def startup_log(events: DataFrame) -> DataFrame:
    logs = events.select(
        text("user_id").alias("mid"),
        text("user_id").alias("uid"),
        F.lit("shop").alias("appid"),
        (F.col("user_id") % 34).cast("string").alias("area"),
        F.when(F.col("user_id") % 10 < 3, "ios").otherwise("android").alias("os"),
        F.col("event_type").alias("ch"),
        F.lit("startup").alias("type"),
        F.concat(F.lit("1.1."), (F.col("event_id") % 3).cast("string")).alias("vs"),
        millis("ts").alias("ts"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        "event_id",
    )
    return with_log_time(logs)


def event_info(events: DataFrame, users: int = 15) -> DataFrame:
    """``users`` accounts share a device, so devices grow with the table."""
    kind = F.col("event_type")
    return events.select(
        F.floor(F.col("user_id") / F.lit(users)).cast("string").alias("mid"),
        text("user_id").alias("uid"),
        F.when(kind == "view", "coupon")
        .when(kind == "purchase", "clickItem")
        .otherwise(kind)
        .alias("evid"),
        item().alias("itemid"),
        millis("ts").alias("ts"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        "event_id",
    )


def raw_logs(events: DataFrame) -> DataFrame:
    """Log lines as JSON text, with the arrival time beside them."""
    kind = F.col("event_type")
    record = F.struct(
        F.when(kind == "signup", "startup").when(kind != "error", "event").alias("type"),
        (F.col("user_id") % 10).cast("string").alias("mid"),
        text("user_id").alias("uid"),
        kind.alias("evid"),
        millis("ts").alias("ts"),
    )
    return events.select(F.to_json(record).alias("value"), millis("ts").alias("arrived"))


# ---- orders --------------------------------------------------------------


def order_info(orders: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Orders; with ``customers`` they get the province of the buyer."""
    hour = F.lpad(((F.col("o_orderkey") * 7) % 24).cast("string"), 2, "0")
    key = F.col("o_orderkey")
    base = orders.select(
        text("o_orderkey").alias("id"),
        text("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":00:00")).alias(
            "create_time"
        ),
        F.concat(F.lit("1"), F.lpad(text("o_custkey"), 10, "0")).alias("consignee_tel"),
        after_epoch(key + (key * 13) % 3600).alias("order_ts"),
    )
    if customers is None:
        return base
    home = customers.select(
        text("c_custkey").alias("user_id"), text("c_nationkey").alias("province_id")
    )
    return base.join(home, "user_id", "left")


def orders_of(
    spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """The order table, cut to days by a predicate on its date column."""
    orders = table(spark, sf_dir, "orders")
    if first is None:
        return orders
    if last is None or last == first:
        return on_day(orders, "o_orderdate", first)
    date = F.col("o_orderdate").cast("date")
    return orders.filter(date.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def lines_of(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """The order lines; with ``day`` those of that day's orders.

    Lines carry no day. The semi join cuts them before anything is added to them.
    """
    lines = table(spark, sf_dir, "lineitem")
    if day is None:
        return lines
    keys = orders_of(spark, sf_dir, day).select(F.col("o_orderkey").alias("l_orderkey"))
    return lines.join(keys, "l_orderkey", "left_semi")


def day_before(day: str) -> str:
    return str(dt.date.fromisoformat(day) - dt.timedelta(days=1))


def order_detail(lines: DataFrame, parts: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    spread = (F.col("l_linenumber").cast("bigint") * F.col("l_partkey")) % 7201
    names = parts.select("p_partkey", F.col("p_name").alias("sku_name"))
    joined = lines.join(names, F.col("l_partkey") == F.col("p_partkey"), "left")
    return joined.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        text("l_orderkey").alias("order_id"),
        "sku_name",
        text("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("order_price"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
        F.col("l_linenumber").alias("line_number"),
        after_epoch(key + spread).alias("detail_ts"),
    )


# ---- users and provinces -------------------------------------------------


def user_info(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), ((key * 97) % 15000).cast("int"))
    return customers.select(
        text("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        born.cast("string").alias("birthday"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def without_debt(customers: DataFrame) -> DataFrame:
    """For look-ups that should miss some: no record of customers in debt."""
    return customers.filter(F.col("c_acctbal") >= 0)


def user_feed(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """User changes: each user is inserted once, and each order sets a new level."""
    users = user_info(customers)
    inserts = users.select("id", "login_name", "user_level", F.lit(0).cast("bigint").alias("version"))
    updates = orders.select(
        text("o_custkey").alias("id"),
        F.concat(F.lit("Customer of order "), text("o_orderkey")).alias("login_name"),
        F.col("o_orderpriority").alias("user_level"),
        (F.col("o_orderkey") + 1).alias("version"),
    )
    return inserts.unionByName(updates)


def provinces(nations: DataFrame) -> DataFrame:
    return nations.select(
        text("n_nationkey").alias("province_id"), F.col("n_name").alias("province")
    )


# ---- change records ------------------------------------------------------


def changes(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Change envelopes: one per order, order line and customer."""

    def envelope(
        rows: DataFrame, name: str, skipped: Column, updated: Column, deleted: Column, **columns
    ) -> DataFrame:
        pairs = [
            F.struct(F.lit(n).alias("name"), c.cast("string").alias("value"))
            for n, c in columns.items()
        ]
        return rows.select(
            F.when(skipped, "TRANSACTIONEND").otherwise("ROWDATA").alias("entry_type"),
            F.lit(name).alias("table"),
            F.when(updated, "UPDATE").when(deleted, "DELETE").otherwise("INSERT").alias("op"),
            F.array(F.array(*pairs)).alias("rows"),
        )

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(18,2)")

    heads = envelope(
        orders,
        "order_info",
        F.col("o_orderpriority") == "5-LOW",
        F.col("o_orderstatus") == "F",
        F.col("o_orderstatus") == "P",
        id=F.col("o_orderkey"),
        user_id=F.col("o_custkey"),
        total_amount=exact("o_totalprice"),
        order_comment=F.lit(None),
    )
    tails = envelope(
        lines,
        "order_detail",
        F.col("l_discount") == 0,
        F.col("l_returnflag") == "A",
        F.col("l_returnflag") == "R",
        id=F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        order_id=F.col("l_orderkey"),
        order_price=exact("l_extendedprice"),
    )
    users = envelope(
        customers,
        "user_info",
        F.col("c_acctbal") < 0,
        F.col("c_mktsegment") == "MACHINERY",
        F.col("c_mktsegment") == "HOUSEHOLD",
        id=F.col("c_custkey"),
        login_name=F.col("c_name"),
        user_level=F.col("c_mktsegment"),
    )
    return heads.unionByName(tails).unionByName(users)
