"""Log lines and change records on literal rows."""

import json

from pyspark.sql import functions as F

from helpers import plan, rows
from retailtide.operators.changes import flatten_rows, route_changes
from retailtide.operators.logs import route_logs, stamp, with_archive_day
from retailtide.operators.orders import order_amount
from retailtide.schemas import CHANGE, EVENT
from retailtide.sources import kafka_options, parse_changes, parse_records, rejected_records
from retailtide.streaming import change_stream


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse(spark):
    good = ['{"mid": 7, "uid": "u", "more": [1], "ts": 5}', '{"mid": {"a": 1}, "ts": "6"}', "{}"]
    bad = ['{"uid": "u"', "7", '"text"', '[{"uid": "u"}]', "", "  ", "no", None]
    texts = raw(spark, *good, *bad)
    parsed = parse_records(texts, EVENT).select("mid", "uid", "evid", "ts")
    assert rows(parsed) == [
        # columns by name: evid, mid, ts, uid
        (None, "7", 5, "u"),
        (None, '{"a":1}', 6, None),
        (None, None, None, None),
    ]
    rejected = [r["value"] for r in rejected_records(texts, EVENT).collect()]
    assert sorted(map(str, rejected)) == sorted(map(str, bad))


def test_a_text_is_parsed_once(spark):
    records = parse_records(raw(spark, "{}"), EVENT)
    used = records.filter((F.col("mid") == "m") & (F.col("uid") == "u") & (F.col("ts") > 1))
    assert plan(used).count("from_json") == 1


def test_route(spark):
    texts = raw(spark, '{"type": "startup"}', '{"type": "event"}', '{"mid": "m"}', '{"type": null}')
    topics = [row["topic"] for row in route_logs(texts).collect()]
    assert topics == ["startup", "event", "event", "event"]


def test_stamp_replaces_the_time_and_keeps_the_rest(spark):
    texts = raw(spark, '{"mid": "m", "ts": 1, "deep": {"a": [1, 2.5]}, "n": 3}')
    stamped = with_archive_day(stamp(texts, F.lit(1566086400000)))
    row = stamped.first()
    assert json.loads(row["value"]) == {
        "mid": "m",
        "ts": 1566086400000,
        "deep": {"a": [1, 2.5]},
        "n": 3,
    }
    assert str(row["log_date"]) == "2019-08-18"
    assert rows(parse_records(stamped.select("value"), EVENT).select("mid", "ts")) == [
        ("m", 1566086400000)
    ]


def test_stamp_takes_the_clock_by_default(spark):
    assert stamp(raw(spark, "{}")).first()["ts"] > 1_600_000_000_000


def change(kind, table, op, *images):
    return (kind, table, op, [[(k, v) for k, v in image.items()] for image in images])


def test_changes(spark):
    frame = spark.createDataFrame(
        [
            change("ROWDATA", "order_info", "INSERT", {"id": "1"}, {"id": "2"}),
            change("ROWDATA", "order_info", "UPDATE", {"id": "3"}),
            change("ROWDATA", "order_info", "DELETE", {"id": "4"}),
            change("ROWDATA", "order_detail", "INSERT", {"id": "5", "img_url": None}),
            change("ROWDATA", "order_detail", "UPDATE", {"id": "6"}),
            change("ROWDATA", "user_info", "INSERT", {"id": "7"}),
            change("ROWDATA", "user_info", "UPDATE", {"id": "8"}),
            change("ROWDATA", "user_info", "DELETE", {"id": "9"}),
            change("ROWDATA", "other", "INSERT", {"id": "10"}),
            change("TRANSACTIONEND", "order_info", "INSERT", {"id": "11"}),
        ],
        CHANGE,
    )
    flat = flatten_rows(route_changes(frame)).collect()
    # the last value of a repeated column wins, one without a name is left out
    twice = spark.createDataFrame(
        [("order", "order_info", "INSERT", [("a", "1"), (None, "x"), ("b", None), ("a", "2")])],
        "topic string, table string, op string, columns array<struct<name:string,value:string>>",
    )
    assert json.loads(flatten_rows(twice).first()["value"]) == {"b": None, "a": "2"}
    found = [(row["topic"], json.loads(row["value"])) for row in flat]
    assert found == [
        ("order", {"id": "1"}),
        ("order", {"id": "2"}),
        ("order_detail", {"id": "5", "img_url": None}),
        ("user_info", {"id": "7"}),
        ("user_info", {"id": "8"}),
    ]
    # the same through JSON texts, as they come from a topic
    texts = frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    again = [(row["topic"], json.loads(row["value"])) for row in change_stream(texts).collect()]
    assert again == found
    assert parse_changes(texts).count() == 10


def test_routes_are_an_argument(spark):
    frame = spark.createDataFrame([change("ROWDATA", "order_info", "UPDATE", {"id": "3"})], CHANGE)
    routes = {("order_info", "UPDATE"): "order"}
    assert route_changes(frame, routes).first()["topic"] == "order"


def test_kafka_options():
    options = kafka_options("b:9092", "startup", max_per_trigger=100)
    assert options["subscribe"] == "startup"
    assert options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "100"
    assert "group.id" not in " ".join(options)


def test_a_repeated_key_keeps_its_last_value(spark):
    raw = spark.createDataFrame([('{"a":1,"ts":3,"a":2}',), ("broken",), (None,)], "value string")
    found = [r["value"] for r in stamp(raw, F.lit(7)).collect()]
    assert json.loads(found[0]) == {"a": 2, "ts": 7} and found[2] is None


def test_an_amount_too_large_counts_in_no_sum(spark):
    frame = spark.createDataFrame([("d", "h", 1e40), ("d", "h", float("nan")), ("d", "h", 1e17), ("d", "h", 0.1)], "create_date string, create_hour string, total_amount double")
    assert order_amount(frame, "d").first()[0] == 1e17
