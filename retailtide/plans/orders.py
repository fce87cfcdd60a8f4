"""Order and user queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import age_years
from ..operators import orders as ops, users
from ..operators.latest import latest_by_key
from .entities import (
    AS_OF,
    order_detail,
    order_info,
    orders_of,
    provinces,
    table,
    user_feed,
    user_info,
)

DAY = "1998-05-07"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_info(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def order_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.enrich_orders(_orders(spark, sf_dir)).drop("order_ts")


def order_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = ops.enrich_orders(order_info(orders_of(spark, sf_dir, DAY)))
    return ops.order_amount(day, DAY)


def order_amount_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = ops.enrich_orders(order_info(orders_of(spark, sf_dir, DAY)))
    return ops.order_amount_by_hour(day, DAY)


def first_order_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_info(table(spark, sf_dir, "orders")).select("id", "user_id", "create_time")
    return ops.with_first_order_flag(orders)


def province_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = provinces(table(spark, sf_dir, "nation"))
    return ops.sales_by_province(_orders(spark, sf_dir), names)


def user_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = user_feed(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))
    return users.latest_users(feed, ["version"])


def user_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = user_info(table(spark, sf_dir, "customer"))
    age = age_years(F.col("birthday"), F.lit(AS_OF).cast("date"))
    return known.select("id", "birthday", age.alias("user_age"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers repeat within an order: the last one to arrive stays."""
    parts = table(spark, sf_dir, "part")
    # names are added to the rows that stay
    details = order_detail(table(spark, sf_dir, "lineitem"), parts.limit(0)).drop("sku_name")
    latest = latest_by_key(details, ["order_id", "line_number"], ["detail_ts", "id", "order_price"])
    names = parts.select(F.col("p_partkey").cast("string").alias("sku_id"), F.col("p_name").alias("sku_name"))
    return latest.join(names, "sku_id", "left").select("order_id", "line_number", "id", "sku_name", "order_price")


QUERIES = {
    f.__name__: f
    for f in (
        order_enriched,
        order_amount,
        order_amount_hour,
        first_order_flag,
        province_sales,
        user_latest,
        user_age,
        upsert_latest,
    )
}

ORDERS_SQL = """
ord AS (
  SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS user_id, o_orderstatus AS order_status,
         o_totalprice AS total_amount, o_totalprice::DECIMAL(18,2) AS amount,
         strftime(o_orderdate, '%Y-%m-%d') || ' '
           || lpad(((o_orderkey * 7) % 24)::VARCHAR, 2, '0') || ':00:00' AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         lpad(((o_orderkey * 7) % 24)::VARCHAR, 2, '0') AS create_hour,
         '1' || lpad(o_custkey::VARCHAR, 10, '0') AS tel,
         c_nationkey::VARCHAR AS province_id,
         o_orderkey + (o_orderkey * 13) % 3600 AS order_s
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
)"""

DETAILS_SQL = """
det AS (
  SELECT l_orderkey::VARCHAR || '_' || l_linenumber::VARCHAR || '_' || l_partkey::VARCHAR
           || '_' || l_suppkey::VARCHAR AS id,
         l_orderkey::VARCHAR AS order_id, p_name AS sku_name, l_partkey::VARCHAR AS sku_id,
         l_extendedprice::DECIMAL(18,2) AS order_price, l_linenumber AS line_number,
         l_orderkey + (l_linenumber::BIGINT * l_partkey) % 7201 AS detail_s
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
)"""

USERS_SQL = f"""
usr AS (
  SELECT c_custkey::VARCHAR AS id, c_name AS login_name, c_mktsegment AS user_level,
         (DATE '1960-01-01' + ((c_custkey * 97) % 15000)::INTEGER)::DATE AS born,
         date_diff('day', (DATE '1960-01-01' + ((c_custkey * 97) % 15000)::INTEGER)::DATE,
                   DATE '{AS_OF}') // 365 AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer
)"""

# users of look-ups that should miss some
KNOWN_SQL = USERS_SQL.replace("FROM customer", "FROM customer WHERE c_acctbal >= 0")

ORACLE = {
    "order_enriched": f"""
WITH {ORDERS_SQL}
SELECT id, user_id, order_status, total_amount, province_id,
       substr(tel, 1, 4) || '*******' AS consignee_tel, create_time, create_date, create_hour
FROM ord""",
    "order_amount": f"""
WITH {ORDERS_SQL}
SELECT sum(amount)::DOUBLE AS total_amount FROM ord WHERE create_date = '{DAY}'""",
    "order_amount_hour": f"""
WITH {ORDERS_SQL}
SELECT create_hour, sum(amount)::DOUBLE AS total_amount FROM ord
WHERE create_date = '{DAY}' GROUP BY create_hour""",
    "first_order_flag": f"""
WITH {ORDERS_SQL}
SELECT id, user_id, create_time,
       CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
            THEN 1 ELSE 0 END AS is_first_order
FROM ord""",
    "province_sales": f"""
WITH {ORDERS_SQL}
SELECT province_id, n_name AS province, count(*) AS orders, sum(amount)::DOUBLE AS amount,
       least(count(*) // 100, 5)::INTEGER AS bin
FROM ord LEFT JOIN nation ON n_nationkey::VARCHAR = province_id
GROUP BY province_id, n_name""",
    "user_latest": f"""
WITH {USERS_SQL}, feed AS (
  SELECT id, login_name, user_level, 0 AS version FROM usr
  UNION ALL
  SELECT o_custkey::VARCHAR, 'Customer of order ' || o_orderkey::VARCHAR, o_orderpriority,
         o_orderkey + 1 FROM orders
)
SELECT id, login_name, user_level, version FROM feed
QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1""",
    "user_age": f"""
WITH {USERS_SQL}
SELECT id, strftime(born, '%Y-%m-%d') AS birthday, age::INTEGER AS user_age FROM usr""",
    "upsert_latest": f"""
WITH {DETAILS_SQL}
SELECT order_id, line_number, id, sku_name, order_price::VARCHAR AS order_price FROM det
QUALIFY row_number() OVER (PARTITION BY order_id, line_number
                           ORDER BY detail_s DESC, id DESC,
                                    order_price::VARCHAR DESC) = 1""",
}
