"""Stream queries: each replays a given table as a stream into a stored table.

They write below ``spark.checkpoint.dir`` and return what was stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import streaming
from ..schemas import BROKEN_TOPIC, EVENT, ORDER
from ..session import use_utc, work_folder
from ..sinks import archive_by_day, routed_files
from ..sources import file_stream, parse_records, replay_bounded, replay_in_order
from . import alerts as alert_plans
from .entities import (
    AS_OF,
    changes,
    event_info,
    order_detail,
    order_info,
    raw_logs,
    startup_log,
    table,
    user_feed,
    user_info,
    without_debt,
)
from .ingest import CHANGES_SQL, RAW_SQL
from .orders import ORACLE as ORDER_ORACLE
from .sales import ORACLE as SALE_ORACLE
from .visits import ORACLE as VISIT_ORACLE

# Micro-batches of a replay in time order, which the tables themselves are not in.
BATCHES = 4

# Rows of a micro-batch that a stateful job takes in, at most, and partitions for as many; its state is of that size.
BATCH_ROWS = 2_000_000
BATCH_PARTITIONS = 24

# How long after its event a log line arrives, where that shows.
LATE_MS = 3_600_000

# A live batch holds a few days, and a folder per day serves the reports. A replay
# writes years in one batch, which would be thousands of folders with a file each.
ONE_FOLDER: tuple[str, ...] = ()


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return file_stream(use_utc(spark), f"{sf_dir.rstrip('/')}/{name}.parquet", schema)


def _text(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast("string") for name in names})


def src_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic of JSON texts, parsed on arrival."""
    work = work_folder(spark, "src_stream")
    records = parse_records(raw_logs(_stream(spark, sf_dir, "events")), EVENT)
    streaming.drain(
        records.select("type", "mid", "uid", "evid", "ts")
        .writeStream.format("parquet")
        .option("path", f"{work}/data")
        .option("checkpointLocation", f"{work}/checkpoint")
    )
    return spark.read.parquet(f"{work}/data")


def log_archive_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "log_archive")
    raw = raw_logs(_stream(spark, sf_dir, "events"))
    stamped = streaming.log_archive_stream(raw, F.col("arrived"))
    streaming.drain(archive_by_day(stamped, f"{work}/data", f"{work}/checkpoint"))
    archive = spark.read.text(f"{work}/data")
    per_day = archive.groupBy("log_date").agg(F.count("*").alias("records"))
    return _text(per_day, "log_date")


def log_archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive holds: each record whole, its time replaced by that of its arrival."""
    work = work_folder(spark, "log_archive")
    raw = raw_logs(_stream(spark, sf_dir, "events"))
    stamped = streaming.log_archive_stream(raw, F.col("arrived") + LATE_MS)
    streaming.drain(archive_by_day(stamped, f"{work}/data", f"{work}/checkpoint"))
    archive = spark.read.text(f"{work}/data")
    records = parse_records(archive, EVENT, keep=("log_date",))
    return _text(records, "log_date").select("log_date", "type", "mid", "uid", "evid", "ts")


def raw_quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of both raw topics: errors and urgent orders come cut short, some orders without a type."""
    work = work_folder(spark, "raw_quarantine")
    value, evid = F.col("value"), F.get_json_object("value", "$.evid")
    cut = F.expr("left(value, length(value) - 1)")
    logs = raw_logs(_stream(spark, sf_dir, "events"))
    logs = logs.withColumn("value", F.when(evid == "error", cut).otherwise(value))
    names = ("orders", "lineitem", "customer")
    raw = changes(*[_stream(spark, sf_dir, name) for name in names]).select(F.to_json(F.struct("*")).alias("value"))
    kind = F.concat_ws(" ", F.get_json_object("value", "$.table"), F.get_json_object("value", "$.op"))
    untyped = F.regexp_replace("value", '"entry_type":"[A-Z]*",', "")
    raw = raw.withColumn("value", F.when(kind == "order_info INSERT", cut).when(kind == "order_info DELETE", untyped).otherwise(value))
    for name, routed in (("logs", streaming.log_route_stream(logs, F.col("arrived"))), ("changes", streaming.change_stream(raw))):
        streaming.drain(routed_files(routed, f"{work}/{name}", f"{work}/checkpoint-{name}"))
    letters = spark.read.text([f"{work}/{name}/topic={BROKEN_TOPIC}" for name in ("logs", "changes")])
    record = F.from_json("value", "source string, reason string, value string")
    found = letters.select(record.alias("r")).select("r.*")
    # the texts are no JSON, so the key is cut out of them
    uid = F.regexp_extract("value", '"uid":"([0-9]+)"', 1)
    order = F.regexp_extract("value", '"name":"id","value":"([0-9]+)"', 1)
    key = F.when(F.col("source") == "raw_log", uid).otherwise(order)
    return found.select("source", "reason", key.alias("key"))


def log_route_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "log_route")
    raw = raw_logs(_stream(spark, sf_dir, "events"))
    routed = streaming.log_route_stream(raw, F.col("arrived"))
    streaming.drain(routed_files(routed, f"{work}/data", f"{work}/checkpoint"))
    stored = spark.read.text(f"{work}/data")
    records = parse_records(stored, EVENT, keep=("topic",))
    return records.select("topic", "mid", "uid", "evid", "ts")


def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes as JSON texts, routed to one folder per topic."""
    work = work_folder(spark, "cdc")
    names = ("orders", "lineitem", "customer")
    envelopes = changes(*[_stream(spark, sf_dir, name) for name in names])
    raw = envelopes.select(F.to_json(F.struct("*")).alias("value"))
    flat = streaming.change_stream(raw)
    streaming.drain(routed_files(flat, f"{work}/data", f"{work}/checkpoint"))
    stored = spark.read.text(f"{work}/data")
    return stored.select("topic", F.get_json_object("value", "$.id").alias("id"))


def dau_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = work_folder(spark, "dau")
    visits = streaming.visit_table(f"{work}/visits")
    logs = startup_log(_stream(spark, sf_dir, "events"))
    streaming.drain(
        streaming.visit_stream(logs, visits, f"{work}/checkpoint", ("event_id",))
    )
    return _text(visits.read(spark), "log_date")


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in time order, in several batches."""
    work = work_folder(spark, "order")
    names = ["id", "user_id", "order_status", "total_amount", "consignee_tel", "create_time"]
    schema = T.StructType([ORDER[name] for name in names])
    orders = streaming.order_table(f"{work}/orders", schema, ONE_FOLDER)
    feed = replay_in_order({"orders": (table(spark, sf_dir, "orders"), "o_orderdate")}, work, BATCHES)
    rows = order_info(feed["orders"]).select(*names)
    streaming.drain_each(streaming.order_stream(rows, orders, f"{work}/checkpoint", ("create_time",)), feed.arrivals())
    return orders.read(spark)


def user_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records in the order of their versions, in several batches: a later one replaces those stored."""
    work = work_folder(spark, "user")
    users = streaming.user_table(f"{work}/users")
    records = user_feed(*(table(spark, sf_dir, name) for name in ("customer", "orders")))
    feed = replay_in_order({"users": (records, "version")}, work, BATCHES)
    unknown = F.lit(None).cast("string")
    rows = feed["users"].withColumn("birthday", unknown).withColumn("gender", unknown)
    streaming.drain_each(streaming.user_stream(rows, users, f"{work}/checkpoint", ("version",)), feed.arrivals())
    return users.read(spark).select("id", "login_name", "user_level")


def sale_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds in time order, in several batches of bounded size, with the job's own delay and hour."""
    work = work_folder(spark, "sale")
    lines = streaming.sale_table(f"{work}/sales", ONE_FOLDER)
    orders = order_info(table(spark, sf_dir, "orders"))
    details = order_detail(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))
    feeds = replay_bounded({"orders": (orders, "order_ts"), "details": (details, "detail_ts")}, work, BATCHES, BATCH_ROWS)
    users = user_info(without_debt(table(spark, sf_dir, "customer")))
    job = streaming.sale_stream(
        feeds["orders"],
        feeds["details"],
        lambda ids: users.join(ids, "id", "left_semi"),
        lines,
        f"{work}/checkpoint",
        as_of=AS_OF,
    )
    streaming.follow(job, feeds.arrivals(), BATCH_PARTITIONS)
    return lines.read(spark)


def new_devices_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New devices by day, from the view that the visit job keeps; the logs come in no order."""
    work = work_folder(spark, "new_devices")
    visits, devices = streaming.visit_table(f"{work}/visits", ONE_FOLDER), streaming.device_table(f"{work}/devices")
    events = table(spark, sf_dir, "events")
    # batches by a number that has nothing to do with time
    mixed = events.withColumn("turn", F.timestamp_seconds(F.col("event_id") % 997))
    feed = replay_in_order({"events": (mixed, "turn")}, work, BATCHES)
    job = streaming.visit_stream(startup_log(feed["events"]), visits, f"{work}/checkpoint", ("event_id",), devices)
    streaming.drain_each(job, feed.arrivals())
    found = devices.new.read(spark).filter("is_new").groupBy("first_date").agg(F.count("*").alias("new_devices"))
    return _text(found, "first_date")


def coupon_alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts, windows still open included; all events come in one batch, in no order."""
    work = work_folder(spark, "alert")
    found = streaming.alert_table(f"{work}/alerts")
    events = event_info(_stream(spark, sf_dir, "events"))
    streaming.drain(streaming.alert_stream(events, found, f"{work}/checkpoint", alert_plans.SIZE, alert_plans.SLIDE))
    return alert_plans.shown(found.read(spark))


def coupon_alert_document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the live alerts, a row per member; events come in time order, in several batches."""
    work = work_folder(spark, "alert")
    found = streaming.alert_table(f"{work}/alerts")
    feed = replay_in_order({"events": (table(spark, sf_dir, "events"), "ts")}, work, BATCHES)
    events = event_info(feed["events"])
    job = streaming.alert_stream(events, found, f"{work}/checkpoint", alert_plans.SIZE, alert_plans.SLIDE)
    streaming.drain_each(job, feed.arrivals())
    return found.documents(spark)


QUERIES = {
    f.__name__: f
    for f in (
        src_stream,
        log_archive_daily,
        log_archive_lines,
        raw_quarantine_stream,
        log_route_stream,
        cdc_stream,
        dau_stream,
        order_stream,
        user_stream,
        sale_stream,
        new_devices_stream,
        coupon_alert_stream,
        coupon_alert_document_stream,
    )
}

ORACLE = {
    "src_stream": f"WITH {RAW_SQL} SELECT type, mid, uid, evid, ts FROM raw",
    "log_archive_daily": """
SELECT strftime(ts, '%Y-%m-%d') AS log_date, count(*) AS records FROM events GROUP BY ALL""",
    "log_archive_lines": f"""
WITH {RAW_SQL}
SELECT strftime(make_timestamp((ts + {LATE_MS}) * 1000), '%Y-%m-%d') AS log_date, type, mid, uid, evid, ts + {LATE_MS} AS ts
FROM raw""",
    "raw_quarantine_stream": """
SELECT 'raw_log' AS source, 'broken' AS reason, user_id::VARCHAR AS key FROM events WHERE event_type = 'error'
UNION ALL
SELECT 'raw_change', CASE o_orderstatus WHEN 'P' THEN 'no type' ELSE 'broken' END, o_orderkey::VARCHAR
FROM orders WHERE o_orderstatus <> 'F'""",
    "log_route_stream": f"""
WITH {RAW_SQL}
SELECT CASE WHEN type = 'startup' THEN 'startup' ELSE 'event' END AS topic, mid, uid, evid, ts
FROM raw""",
    "cdc_stream": f"WITH {CHANGES_SQL} SELECT topic, id FROM routed",
    "dau_stream": VISIT_ORACLE["dau_detail"],
    "order_stream": f"""
SELECT id, user_id, order_status, total_amount, consignee_tel, create_time, create_date,
       create_hour
FROM ({ORDER_ORACLE['order_enriched']}) o""",
    "user_stream": f"""
SELECT id, login_name, user_level FROM ({ORDER_ORACLE['user_latest']}) u""",
    "sale_stream": SALE_ORACLE["sale_detail_wide"],
    "new_devices_stream": """
SELECT strftime(first, '%Y-%m-%d') AS first_date, count(*) AS new_devices
FROM (SELECT user_id, min(ts) AS first FROM events GROUP BY user_id) GROUP BY 1""",
    "coupon_alert_stream": alert_plans.ORACLE["coupon_alert"],
    "coupon_alert_document_stream": alert_plans.ORACLE["coupon_alert_document"],
}
