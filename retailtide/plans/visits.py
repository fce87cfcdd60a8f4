"""Visitor queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import dashboard, visits
from ..operators.orders import enrich_orders
from ..schemas import VISIT_COLUMNS
from .entities import day_before, order_info, orders_of, startup_log, table

DAY = "2024-01-15"
FIRST_DAY = "2024-01-02"
ORDER_DAY = "1998-05-07"


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return startup_log(table(spark, sf_dir, "events"))


def _day(day: str):
    return F.lit(day).cast("date")


def _iso(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast("string") for name in names or ("log_date",)})


def startup_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")
    )
    return _iso(visits.with_log_time(logs).drop("event_ts"))


def dau_first_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = visits.first_visits(_logs(spark, sf_dir), ["event_id"])
    return _iso(firsts.select("mid", "log_date", "log_hour", "event_id", "ts"))


def dau_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(visits.first_visits(_logs(spark, sf_dir), ["event_id"]).select(*VISIT_COLUMNS))


def dau_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Afternoon logs of devices that were not there in the morning."""
    logs = _logs(spark, sf_dir)
    seen = logs.filter(F.col("log_hour") < "12").select("mid", "log_date").distinct()
    batch = logs.filter(F.col("log_hour") >= "12")
    return _iso(visits.unseen(batch, seen).select("event_id", "mid", "log_date", "log_hour"))


def dau_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visit_total(visits.first_visit_times(_logs(spark, sf_dir)), _day(DAY))


def dau_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits_by_hour(visits.first_visit_times(_logs(spark, sf_dir)), _day(DAY))


def dau_hour_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.compare_visits(visits.first_visit_times(_logs(spark, sf_dir)), DAY)


def new_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.new_devices(_logs(spark, sf_dir), _day(FIRST_DAY))


def realtime_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources hold the same day only by an offset of the order dates."""
    logs = _logs(spark, sf_dir)
    orders = enrich_orders(order_info(table(spark, sf_dir, "orders")))
    moved = orders.withColumn(
        "create_date", F.date_add(F.to_date("create_date"), SHIFT_DAYS).cast("string")
    )
    return dashboard.day_totals(logs, moved, FIRST_DAY)


# days from ORDER_DAY to FIRST_DAY
SHIFT_DAYS = 9371


def order_hour_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = orders_of(spark, sf_dir, day_before(ORDER_DAY), ORDER_DAY)
    return dashboard.compare_orders(enrich_orders(order_info(days)), ORDER_DAY)


QUERIES = {
    f.__name__: f
    for f in (
        dau_hour,
        startup_dates,
        dau_first_per_device,
        dau_detail,
        dau_new_only,
        dau_total,
        dau_hour_compare,
        new_devices,
        realtime_total,
        order_hour_compare,
    )
}

_LOGS = """
logs AS (
  SELECT event_id, user_id::VARCHAR AS mid, event_type AS ch, ts AS event_ts,
         epoch_us(ts) // 1000 AS ts, user_id,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events
),
firsts AS (
  SELECT * FROM logs
  QUALIFY row_number() OVER (PARTITION BY mid, log_date ORDER BY event_ts, event_id) = 1
)"""

_HOURS = "hours AS (SELECT lpad(h::VARCHAR, 2, '0') AS hour FROM range(24) t(h))"

_ORDERS = """
ord AS (
  SELECT o_totalprice::DECIMAL(18,2) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
         o_orderdate::DATE AS create_day,
         lpad(((o_orderkey * 7) % 24)::VARCHAR, 2, '0') AS create_hour
  FROM orders
)"""

ORACLE = {
    "startup_dates": f"""
WITH {_LOGS} SELECT event_id, ts, log_date, log_hour FROM logs""",
    "dau_first_per_device": f"""
WITH {_LOGS} SELECT mid, log_date, log_hour, event_id, ts FROM firsts""",
    "dau_detail": f"""
WITH {_LOGS}
SELECT mid, mid AS uid, 'shop' AS appid, (user_id % 34)::VARCHAR AS area,
       CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os, ch, 'startup' AS type,
       '1.1.' || (event_id % 3)::VARCHAR AS vs, log_date, log_hour, ts
FROM firsts""",
    "dau_new_only": f"""
WITH {_LOGS}
SELECT event_id, mid, log_date, log_hour FROM logs l
WHERE log_hour >= '12' AND NOT EXISTS (
  SELECT 1 FROM logs s
  WHERE s.mid = l.mid AND s.log_date = l.log_date AND s.log_hour < '12')""",
    "dau_total": f"""
WITH {_LOGS} SELECT count(*) AS visitors FROM firsts WHERE log_date = '{DAY}'""",
    "dau_hour": f"""
WITH {_LOGS}
SELECT log_hour, count(*) AS visitors FROM firsts WHERE log_date = '{DAY}' GROUP BY log_hour""",
    "dau_hour_compare": f"""
WITH {_LOGS}, {_HOURS}
SELECT h.hour, count(*) FILTER (f.log_date = '{DAY}') AS today,
       count(*) FILTER (f.log_date = '{day_before(DAY)}') AS yesterday
FROM hours h LEFT JOIN firsts f ON f.log_hour = h.hour GROUP BY h.hour""",
    "new_devices": f"""
WITH {_LOGS}
SELECT count(*) AS new_devices
FROM (SELECT mid, min(log_date) AS d FROM logs GROUP BY mid) WHERE d = '{FIRST_DAY}'""",
    "realtime_total": f"""
WITH {_LOGS}, {_ORDERS}
SELECT 'dau' AS id, '新增日活' AS name, count(*)::DOUBLE AS value
FROM firsts WHERE log_date = '{FIRST_DAY}'
UNION ALL
SELECT 'new_mid', '新增设备', count(*)::DOUBLE
FROM (SELECT mid, min(log_date) AS d FROM logs GROUP BY mid) WHERE d = '{FIRST_DAY}'
UNION ALL
SELECT 'order_amount', '新增交易额', sum(amount)::DOUBLE
FROM ord WHERE create_day + {SHIFT_DAYS} = DATE '{FIRST_DAY}'""",
    "order_hour_compare": f"""
WITH {_ORDERS}, {_HOURS}
SELECT h.hour,
       coalesce(sum(amount) FILTER (create_date = '{ORDER_DAY}'), 0)::DOUBLE AS today,
       coalesce(sum(amount) FILTER (create_date = '{day_before(ORDER_DAY)}'), 0)::DOUBLE
         AS yesterday
FROM hours h LEFT JOIN ord o ON o.create_hour = h.hour GROUP BY h.hour""",
}
