"""Log and change-record queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.changes import flatten_rows, route_changes
from ..operators.logs import route_logs
from ..schemas import EVENT
from ..sources import parse_records, quarantined
from .entities import changes, raw_logs, table


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(*[table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer")])


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_records(raw_logs(table(spark, sf_dir, "events")), EVENT)
    return records.select("type", "mid", "uid", "evid", "itemid", "ts")


def log_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_logs(raw_logs(table(spark, sf_dir, "events")))
    fields = F.from_json("value", EVENT)
    return routed.select("topic", fields["uid"].alias("uid"), fields["ts"].alias("ts"))


def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_changes(_changes(spark, sf_dir))
    key = F.filter("columns", lambda c: c["name"] == "id")[0]["value"]
    return routed.select("topic", "table", "op", key.alias("id"))


def cdc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_rows(route_changes(_changes(spark, sf_dir)))
    names = "id user_id total_amount order_id order_price login_name user_level".split()
    row = F.from_json("value", ", ".join(f"{name} string" for name in names))
    return flat.select("topic", row.alias("row")).select("topic", "row.*")


def log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log texts of which errors come cut short and purchases without a time."""
    events = table(spark, sf_dir, "events")
    raw = raw_logs(events).withColumn("kind", F.get_json_object("value", "$.evid"))
    cut = F.when(F.col("kind") == "error", F.expr("left(value, length(value) - 1)"))
    cut = cut.when(F.col("kind") == "purchase", F.regexp_replace("value", ',"ts":[0-9]+', ""))
    bad = quarantined(raw.select(F.coalesce(cut, F.col("value")).alias("value")), EVENT)
    uid = F.regexp_extract("value", '"uid":"([0-9]+)"', 1)
    return bad.select("reason", uid.alias("uid"))


QUERIES = {f.__name__: f for f in (parse_events, log_route, log_quarantine, cdc_route, cdc_flatten)}

_RAW = """
raw AS (
  SELECT CASE event_type WHEN 'signup' THEN 'startup' WHEN 'error' THEN NULL ELSE 'event' END
           AS type,
         (user_id % 10)::VARCHAR AS mid, user_id::VARCHAR AS uid, event_type AS evid,
         epoch_us(ts) // 1000 AS ts
  FROM events
)"""

_CHANGES = """
changes AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'UPDATE' WHEN 'P' THEN 'DELETE' ELSE 'INSERT' END AS op,
         'order_info' AS "table", 'order' AS topic, o_orderpriority <> '5-LOW' AS is_row,
         o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS user_id,
         o_totalprice::DECIMAL(18,2)::VARCHAR AS total_amount, NULL AS order_id,
         NULL AS order_price, NULL AS login_name, NULL AS user_level
  FROM orders
  UNION ALL
  SELECT CASE l_returnflag WHEN 'A' THEN 'UPDATE' WHEN 'R' THEN 'DELETE' ELSE 'INSERT' END,
         'order_detail', 'order_detail', l_discount <> 0,
         l_orderkey::VARCHAR || '_' || l_linenumber::VARCHAR || '_' || l_partkey::VARCHAR
           || '_' || l_suppkey::VARCHAR, NULL, NULL, l_orderkey::VARCHAR,
         l_extendedprice::DECIMAL(18,2)::VARCHAR, NULL, NULL
  FROM lineitem
  UNION ALL
  SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'UPDATE' WHEN 'HOUSEHOLD' THEN 'DELETE'
              ELSE 'INSERT' END,
         'user_info', 'user_info', c_acctbal >= 0, c_custkey::VARCHAR, NULL, NULL, NULL, NULL,
         c_name, c_mktsegment
  FROM customer
),
routed AS (
  SELECT * FROM changes
  WHERE is_row AND (op = 'INSERT' OR ("table" = 'user_info' AND op = 'UPDATE'))
)"""

CHANGES_SQL = _CHANGES
RAW_SQL = _RAW

ORACLE = {
    "parse_events": f"""
WITH {_RAW} SELECT type, mid, uid, evid, NULL::VARCHAR AS itemid, ts FROM raw""",
    "log_route": f"""
WITH {_RAW}
SELECT CASE WHEN type = 'startup' THEN 'startup' ELSE 'event' END AS topic, uid, ts FROM raw""",
    "log_quarantine": """
SELECT CASE event_type WHEN 'error' THEN 'broken' ELSE 'no time' END AS reason,
       user_id::VARCHAR AS uid
FROM events WHERE event_type IN ('error', 'purchase')""",
    "cdc_route": f"""
WITH {_CHANGES} SELECT topic, "table", op, id FROM routed""",
    "cdc_flatten": f"""
WITH {_CHANGES}
SELECT topic, id, user_id, total_amount, order_id, order_price, login_name, user_level
FROM routed""",
}
