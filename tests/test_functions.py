"""Scalar functions on literal edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailtide import functions as fn


def values(spark, column, *inputs, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(column).collect()]


def test_phone(spark):
    found = values(spark, fn.mask_phone(F.col("v")), "13012345678", "123", "", None)
    assert found == ["1301*******", "123*******", "*******", None]


def test_create_time(spark):
    times = ["2019-08-18 09:05:00", "2019-08-18", None, ""]
    assert values(spark, fn.created_date(F.col("v")), *times)[:3] == ["2019-08-18"] * 2 + [None]
    assert values(spark, fn.created_hour(F.col("v")), *times) == ["09", None, None, None]


def test_age_counts_years_of_365_days(spark):
    day = F.lit("2019-08-18").cast("date")
    found = values(spark, fn.age_years(F.col("v"), day), "1990-08-19", "2019-08-18", "x", None)
    assert found == [29, 0, None, None]


def test_age_band(spark):
    found = values(spark, fn.age_band(F.col("v")), 19, 20, 30, 31, 0, kind="int")
    assert found == ["under_20", "from_20_to_30", "from_20_to_30", "over_30", "under_20"]


@pytest.mark.parametrize(
    "part, total, expected", [(1, 200, 0.5), (0, 0, 0.0), (1, 3, 33.3), (2, 3, 66.7), (1, 2000, 0.1)]
)
def test_percent(spark, part, total, expected):
    share = fn.one_decimal_percent(F.lit(part), F.lit(total))
    assert spark.range(1).select(share).first()[0] == expected


def test_previous_day(spark):
    found = values(spark, fn.previous_day(F.col("v")), "2019-03-01", "2020-03-01", "2019-1-1", "no")
    assert found == [dt.date(2019, 2, 28), dt.date(2020, 2, 29), dt.date(2018, 12, 31), None]


def test_price(spark):
    assert values(spark, fn.price(F.col("v")), "12.50", "x", None) == [12.5, None, None]


def test_log_times(spark):
    at = fn.event_time(F.col("v"))
    ms = 1566086399999  # 2019-08-17 23:59:59.999
    assert values(spark, fn.log_date(at), ms, ms + 1, kind="bigint") == [
        dt.date(2019, 8, 17),
        dt.date(2019, 8, 18),
    ]
    assert values(spark, fn.log_hour(at), ms, ms + 1, kind="bigint") == ["23", "00"]


@pytest.mark.parametrize(
    "keyword, text, hit",
    [
        ("red gear", "Big Red Gear", True),
        ("gear  RED red", "Big Red Gear", True),
        ("red", "redwood", False),
        ("red gear", "red", False),
        ("", "red", False),
        ("  ", "red", False),
        (None, "red", False),
        ("red", None, False),
        ("red gear", "Red-Gear, big", True),
        ("小米高速双频", "小米高速双频路由器", True),
        ("小米手机", "小米高速双频路由器", False),
        ("路由器 AC1200", "小米路由器AC1200", True),
        ("...", "red", False),
    ],
)
def test_keyword(spark, keyword, text, hit):
    assert values(spark, fn.matches_all(F.col("v"), keyword), text) == [hit]
