"""The shape of the physical plans, and results under a hot key."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from retailtide.operators import alerts, orders, sales, visits
from retailtide.plans.registry import all_queries
from retailtide.operators.latest import latest_by_key

QUERIES = all_queries()
BATCH = sorted(n for n in QUERIES if not n.endswith("_stream") and not n.startswith("log_archive"))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", BATCH)
def test_plan(name, spark, small_dir, no_broadcast):
    text = plan(QUERIES[name](spark, small_dir))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert "Python" not in text
    # a ranking keeps at most one row per key and map task before its shuffle
    ranked = re.findall(r"\bWindow \[row_number", text)
    assert len(re.findall(r"WindowGroupLimit .* Partial", text)) == len(ranked)
    # other windows work on a bucket of time, which holds a fixed number of rows
    for keys in re.findall(r"\bWindow \[(?!row_number).*\], \[(.*?)\], \[", text):
        assert keys.startswith("bucket#")
    # what meets in one task has been aggregated by the map side
    for child in re.findall(r"Exchange SinglePartition.*\n\W*(?:\(\d+\) )?(\w+)", text):
        assert child in ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "Range")


@pytest.mark.parametrize("name", BATCH)
def test_no_forced_broadcast(name, spark, small_dir):
    logical = QUERIES[name](spark, small_dir)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in logical.lower()


@pytest.mark.parametrize(
    "name, column",
    [
        ("dau_hour", "ts"),
        ("dau_total", "ts"),
        ("new_devices", "ts"),
        ("realtime_total", "ts"),
        ("order_amount", "o_orderdate"),
        ("order_amount_hour", "o_orderdate"),
        ("sale_search", "o_orderdate"),
    ],
)
def test_day_reaches_the_scan(name, column, spark, small_dir):
    frame = QUERIES[name](spark, small_dir)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        assert re.search(rf"PushedFilters: \[[^\]]*LessThan\({column},", plan(frame))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize(
    "name, columns",
    [
        ("dau_hour", {"ts", "user_id"}),
        ("province_sales", {"o_custkey", "o_totalprice"}),
        ("coupon_alert", {"ts", "user_id", "event_type"}),
    ],
)
def test_only_needed_columns_are_read(name, columns, spark, small_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = plan(QUERIES[name](spark, small_dir))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = [
        {field.split(":")[0] for field in schema.split(",")}
        for schema in re.findall(r"ReadSchema: struct<(.*?)>", text)
    ]
    assert columns in read


# ---- a third of all rows on one key --------------------------------------

ROWS = 30_000


def hot(spark, rows_=ROWS):
    """(id, key, n): key 'hot' on a third of the rows, else one of 5,000."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").otherwise((n % 5000).cast("string"))
    return spark.range(0, rows_, 1, 8).select("id", key.alias("key"), n.alias("n"))


def test_hot_key_is_cut_before_the_shuffle(spark):
    found = latest_by_key(hot(spark), ["key"], ["n"])
    best = hot(spark).groupBy("key").agg(F.max("n").alias("n"))
    assert rows(found.select("key", "n")) == rows(best)
    # the shuffle got at most one row per key and map task
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(latest_by_key(hot(spark), ["key"], ["n"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchange = text.index("Exchange hashpartitioning(key")
    assert "WindowGroupLimit" in text[:exchange] and "Partial" in text[exchange:]


def test_hot_device(spark):
    logs = hot(spark).select(
        F.col("key").alias("mid"), (F.col("n") * 60_000 + 1_566_086_400_000).alias("ts")
    )
    timed = visits.with_log_time(logs)
    firsts = visits.first_visits(timed)
    assert firsts.count() == timed.select("mid", "log_date").distinct().count()
    assert rows(firsts.select("mid", "log_date", "event_ts")) == rows(
        visits.first_visit_times(timed).select("mid", "log_date", "event_ts")
    )


def test_hot_buyer(spark):
    frame = hot(spark).select(
        F.col("id").cast("string").alias("id"),
        F.col("key").alias("user_id"),
        F.format_string("2019-08-%02d 00:00:00", (F.col("n") % 28 + 1)).alias("create_time"),
    )
    found = orders.with_first_order_flag(frame)
    assert found.count() == ROWS
    flagged = found.filter("is_first_order = 1")
    assert flagged.count() == flagged.select("user_id").distinct().count()
    assert flagged.count() == frame.select("user_id").distinct().count()


@pytest.mark.parametrize("salts", [1, 4])
def test_hot_order(spark, salts):
    details = hot(spark).select(
        F.col("id").cast("string").alias("id"),
        F.col("key").alias("order_id"),
        F.lit("s").alias("sku_id"),
        F.lit("red gear").alias("sku_name"),
        F.lit("1.5").alias("order_price"),
        F.timestamp_seconds(F.col("n") % 3600).alias("detail_ts"),
    )
    heads = details.select(
        F.col("order_id").alias("id"),
        F.lit("O").alias("order_status"),
        F.lit("2019-08-18 00:00:00").alias("create_time"),
        F.lit("2019-08-18").alias("create_date"),
        F.lit("u").alias("user_id"),
        F.timestamp_seconds(F.lit(0)).alias("order_ts"),
    ).distinct()
    met = sales.merge_order_and_detail(heads, details, salts=salts)
    assert sales.latest_lines(met).count() == ROWS
    assert sales.details_with_orders_full(
        details.select("id", "order_id"), heads.select("id", "user_id")
    ).count() == ROWS


def test_hot_device_in_one_window(spark):
    """One device with a third of all events and 3,334 accounts in a window."""
    frame = hot(spark).select(
        F.col("key").alias("mid"),
        F.col("id").cast("string").alias("uid"),
        F.lit("coupon").alias("evid"),
        (F.col("n") % 50).cast("string").alias("itemid"),
        F.timestamp_seconds(F.col("n") % 290).alias("event_ts"),
    )
    found = alerts.coupon_alerts(frame, 300, 300)
    top = found.filter("mid = 'hot'").first()
    assert (top["coupon_uids"], top["events"]) == (ROWS // 3, ROWS // 3)
    held = alerts.alert_documents(frame, found.filter("mid = 'hot'"), 300, 300)
    assert held.filter("kind = 'uid'").count() == ROWS // 3
