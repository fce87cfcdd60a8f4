"""Operators on literal rows: visits, orders, sale lines, report."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from retailtide.operators import dashboard, orders, report, sales, users, visits
from retailtide.operators.latest import latest_by_key

MIDNIGHT = 1566086400000  # 2019-08-18 00:00 UTC


def logs(spark, *pairs):
    frame = spark.createDataFrame([(m, ts) for m, ts in pairs], "mid string, ts bigint")
    return visits.with_log_time(frame)


def day(text):
    return F.lit(text).cast("date")


def test_a_device_around_midnight_counts_on_both_days(spark):
    found = visits.first_visits(logs(spark, ("m", MIDNIGHT - 1000), ("m", MIDNIGHT + 1000)))
    assert sorted(str(r["log_date"]) for r in found.collect()) == ["2019-08-17", "2019-08-18"]


def test_first_visit_is_the_earliest(spark):
    frame = logs(spark, ("m", MIDNIGHT + 9), ("m", MIDNIGHT + 3), (None, MIDNIGHT + 5))
    assert rows(visits.first_visits(frame).select("mid", "ts")) == [
        ("m", MIDNIGHT + 3),
        (None, MIDNIGHT + 5),
    ]
    narrow = visits.first_visit_times(frame)
    assert rows(narrow.select("mid", F.unix_millis("event_ts"))) == [
        ("m", MIDNIGHT + 3),
        (None, MIDNIGHT + 5),
    ]


def test_unseen(spark):
    frame = logs(spark, ("a", MIDNIGHT), ("b", MIDNIGHT), ("a", MIDNIGHT - 1))
    seen = logs(spark, ("a", MIDNIGHT + 5))
    assert rows(visits.unseen(frame, seen).select("mid", "ts")) == [
        ("a", MIDNIGHT - 1),
        ("b", MIDNIGHT),
    ]


def test_visit_counts(spark):
    frame = logs(
        spark,
        ("old", MIDNIGHT - 1),
        ("old", MIDNIGHT + 1),
        ("new", MIDNIGHT + 3_600_000),
        ("next", MIDNIGHT + 86_400_000),
    )
    firsts = visits.first_visits(frame)
    assert visits.visit_total(firsts, day("2019-08-18")).first()[0] == 2
    assert rows(visits.visits_by_hour(firsts, day("2019-08-18"))) == [("00", 1), ("01", 1)]
    assert visits.new_devices(frame, day("2019-08-18")).first()[0] == 1
    assert visits.new_devices(frame, day("2020-01-01")).first()[0] == 0


def some_orders(spark):
    return spark.createDataFrame(
        [
            ("1", "u", "2019-08-18 09:05:00", "13012345678", 10.1),
            ("2", "u", "2019-08-18 09:59:00", "123", 0.2),
            ("3", "v", "2019-08-17 23:00:00", None, 5.0),
            ("4", "u", "2019-08-16 00:00:00", "", 1.0),
            ("5", None, "2019-08-18", "1", 7.0),
            ("6", "u", None, "1", 8.0),
        ],
        "id string, user_id string, create_time string, consignee_tel string, total_amount double",
    )


def test_enrich_orders(spark):
    found = orders.enrich_orders(some_orders(spark))
    assert rows(found.select("id", "consignee_tel", "create_date", "create_hour")) == [
        # columns by name: consignee_tel, create_date, create_hour, id
        ("*******", "2019-08-16", "00", "4"),
        ("1*******", "2019-08-18", None, "5"),
        ("1*******", None, None, "6"),
        ("123*******", "2019-08-18", "09", "2"),
        ("1301*******", "2019-08-18", "09", "1"),
        (None, "2019-08-17", "23", "3"),
    ]


def test_order_sums(spark):
    frame = orders.enrich_orders(some_orders(spark))
    assert orders.order_amount(frame, "2019-08-18").first()[0] == 17.3
    assert orders.order_amount(frame, "2001-01-01").first()[0] is None
    assert rows(orders.order_amount_by_hour(frame, "2019-08-18")) == [("09", 10.3), (None, 7.0)]


def test_first_order_flag(spark):
    found = orders.with_first_order_flag(some_orders(spark)).select("id", "is_first_order")
    assert rows(found) == [("1", 0), ("2", 0), ("3", 1), ("4", 1), ("5", 0), ("6", 0)]


def test_provinces(spark):
    many = spark.range(601).select(
        F.when(F.col("id") < 600, "p").otherwise("q").alias("province_id"),
        F.lit(1.5).alias("total_amount"),
    )
    names = spark.createDataFrame([("p", "P")], "province_id string, province string")
    found = orders.sales_by_province(many, names)
    assert rows(found) == [(1.5, 0, 1, None, "q"), (900.0, 5, 600, "P", "p")]
    bins = spark.createDataFrame([(0,), (99,), (100,), (599,), (600,), (601,)], "n bigint")
    assert [r[0] for r in bins.select(orders.colour_bin(F.col("n"))).collect()] == [
        0,
        0,
        1,
        5,
        5,
        5,
    ]


def test_day_totals_and_hours(spark):
    frame = logs(spark, ("a", MIDNIGHT), ("b", MIDNIGHT - 1), ("b", MIDNIGHT + 3_600_000))
    sold = orders.enrich_orders(some_orders(spark))
    totals = {r["id"]: r["value"] for r in dashboard.day_totals(frame, sold, "2019-08-18").collect()}
    assert totals == {"dau": 2.0, "new_mid": 1.0, "order_amount": 17.3}
    empty = {r["id"]: r["value"] for r in dashboard.day_totals(frame, sold, "2001-01-01").collect()}
    assert empty == {"dau": 0.0, "new_mid": 0.0, "order_amount": None}

    firsts = visits.first_visits(frame)
    by_hour = {
        r["hour"]: (r["today"], r["yesterday"])
        for r in dashboard.compare_hours("dau", firsts, sold, "2019-08-18").collect()
    }
    assert len(by_hour) == 24
    assert by_hour["00"] == (1, 0) and by_hour["01"] == (1, 0) and by_hour["23"] == (0, 1)
    amounts = {
        r["hour"]: (r["today"], r["yesterday"])
        for r in dashboard.compare_hours("order_amount", firsts, sold, "2019-08-18").collect()
    }
    assert amounts["09"] == (10.3, 0.0) and amounts["23"] == (0.0, 5.0)
    assert dashboard.compare_hours("other", firsts, sold, "2019-08-18") is None
    nothing = dashboard.compare_visits(firsts, "no date").agg(F.sum("today"), F.sum("yesterday"))
    assert tuple(nothing.first()) == (0, 0)


def test_full_join(spark):
    heads = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, order_status string")
    tails = spark.createDataFrame(
        [("a", "1"), ("b", "1"), ("c", "9"), ("d", None)], "id string, order_id string"
    )
    found = sales.details_with_orders_full(tails, heads)
    full = tails.withColumnRenamed("id", "order_detail_id").join(
        heads.withColumnRenamed("id", "order_id"), "order_id", "full_outer"
    )
    assert rows(found) == rows(full)
    assert found.count() == 5


def feeds(spark, gaps):
    """One order at noon and one detail per gap in seconds."""
    heads = spark.createDataFrame(
        [("1", "O", "2019-08-18 09:05:00", "1301", "u")],
        "id string, order_status string, create_time string, consignee_tel string, user_id string",
    ).withColumn("order_ts", F.lit("2019-08-18 12:00:00").cast("timestamp"))
    tails = spark.createDataFrame(
        [(f"d{i}", "1", "s", "red gear", "2.50", g) for i, g in enumerate(gaps)],
        "id string, order_id string, sku_id string, sku_name string, order_price string, gap int",
    )
    at = F.timestamp_seconds(F.unix_seconds(F.lit("2019-08-18 12:00:00").cast("timestamp")) + F.col("gap"))
    return orders.enrich_orders(heads), tails.withColumn("detail_ts", at).drop("gap")


@pytest.mark.parametrize("salts", [1, 4])
def test_join_life(spark, salts):
    heads, tails = feeds(spark, [0, 3600, 3601, -3600, -3601])
    met = sales.merge_order_and_detail(heads, tails, salts=salts)
    assert sorted(r["order_detail_id"] for r in met.collect()) == ["d0", "d1", "d3"]
    assert "tail_salt" not in met.columns


def test_wide_lines(spark):
    heads, tails = feeds(spark, [5])
    again = heads.withColumn("order_status", F.lit("P")).withColumn(
        "order_ts", F.col("order_ts") + F.expr("interval 1 second")
    )
    people = spark.createDataFrame(
        [("w", "F", "1990-08-19", "1")], "id string, gender string, birthday string, user_level string"
    )
    wide = sales.sale_lines(heads.unionByName(again), tails, people, "2019-08-18")
    row = wide.collect()
    assert len(row) == 1
    assert row[0]["order_status"] == "P"  # the repeated order came later
    assert (row[0]["user_gender"], row[0]["user_level"], row[0]["user_age"]) == (None, None, 0)
    assert (row[0]["dt"], row[0]["sku_price"]) == ("2019-08-18", 2.5)
    known = sales.with_user(wide.select("user_id").withColumn("user_id", F.lit("w")), people, "2019-08-18")
    assert tuple(known.first())[1:] == ("F", 29, "1")


def test_latest(spark):
    feed = spark.createDataFrame(
        [("1", "a", 1), ("1", "b", 3), ("1", "c", 2), ("2", "d", None)],
        "id string, name string, version int",
    )
    assert rows(users.latest_users(feed, ["version"]).select("id", "name")) == [
        ("1", "b"),
        ("2", "d"),
    ]
    assert latest_by_key(feed.limit(0), ["id"], ["version"]).count() == 0


def lines(spark, *people):
    return spark.createDataFrame(
        [(f"{i:03}", "2019-08-18", "red gear", g, a) for i, (g, a) in enumerate(people)],
        "order_detail_id string, dt string, sku_name string, user_gender string, user_age int",
    )


def test_report(spark):
    hits = lines(spark, ("M", 19), ("F", 20), ("M", 30), (None, 0), ("X", 31))
    assert tuple(report.gender_share(hits).first()) == (5, 40.0, 20.0)
    assert tuple(report.age_band_share(hits).first()) == (5, 40.0, 40.0, 20.0)
    assert [tuple(r) for r in report.gender_terms(hits).collect()] == [("M", 2), ("F", 1)]
    assert report.age_terms(hits).count() == 5
    assert tuple(report.gender_share(hits.limit(0)).first()) == (0, 0.0, 0.0)
    answer = report.report(report.search(hits, "2019-08-18", "gear"), 2, 2)
    whole = json.loads(report.as_json(answer).first()[0])
    assert whole["total"] == 5
    assert [s["title"] for s in whole["stat"]] == ["性别占比", "年龄段占比"]
    assert whole["stat"][0]["options"] == [
        {"name": "男", "value": 40.0},
        {"name": "女", "value": 20.0},
    ]
    assert [d["order_detail_id"] for d in whole["detail"]] == ["002", "003"]
    none = json.loads(report.as_json(report.report(report.search(hits, "2019-08-18", ""), 1, 2)).first()[0])
    assert none["total"] == 0 and none["detail"] == []


def test_pages_cover_the_hits(spark):
    hits = lines(spark, *[("M", i) for i in range(7)])
    pages = [[r["order_detail_id"] for r in report.page(hits, n, 3).collect()] for n in (1, 2, 3, 4)]
    assert pages == [["000", "001", "002"], ["003", "004", "005"], ["006"], []]


def test_search_is_by_day(spark):
    hits = lines(spark, ("M", 1))
    assert report.search(hits, "2019-08-18", "red").count() == 1
    assert report.search(hits, "2019-08-19", "red").count() == 0
