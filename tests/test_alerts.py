"""The alert rule on literal rows and against a direct evaluation."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from retailtide.operators import alerts

NOON = 1566129600  # 2019-08-18 12:00 UTC


def events(spark, *found):
    """(mid, uid, evid, itemid, seconds after noon)"""
    frame = spark.createDataFrame(
        [(m, u, e, i, NOON + s) for m, u, e, i, s in found],
        "mid string, uid string, evid string, itemid string, s bigint",
    )
    return frame.withColumn("event_ts", F.timestamp_seconds("s")).drop("s")


def coupons(mid, uids, item="i"):
    return [(mid, u, "coupon", item, n) for n, u in enumerate(uids)]


def test_rule(spark):
    frame = events(
        spark,
        *coupons("three", "abc"),
        *coupons("clicked", "abc"),
        ("clicked", "a", "clickItem", "i", 3),
        *coupons("two", "abab"),
        *coupons("null", ["a", "b", None]),
        *coupons("items", "aaa", None),
        ("other", "a", "addCart", "i", 0),
        ("other", "b", "addCart", "i", 0),
        ("other", "c", "addCart", "i", 0),
    )
    found = alerts.coupon_alerts(frame)
    assert {r["mid"] for r in found.collect()} == {"three"}
    # every window that holds all three: starts from 11:55:05 to 12:00:00
    assert found.count() == 60
    top = found.orderBy(F.col("window_end").desc()).first()
    assert top["coupon_uids"] == 3 and top["coupon_items"] == 1 and top["events"] == 3


def test_a_click_outside_the_window_does_not_matter(spark):
    frame = events(spark, *coupons("m", "abc"), ("m", "a", "clickItem", None, 300))
    ends = [r["window_end"] for r in alerts.coupon_alerts(frame).collect()]
    # windows that start at 12:00:05 or later hold the click but no longer all coupons
    assert len(ends) == 60


def test_one_alert_per_device_and_minute(spark):
    frame = events(spark, *coupons("m", "abc"))
    found = alerts.latest_alerts(alerts.coupon_alerts(frame))
    per_minute = {r["alert_id"]: r["window_end"].second for r in found.collect()}
    assert len(per_minute) == found.count() == 6
    assert sorted(per_minute.values()) == [0, 55, 55, 55, 55, 55]


def direct(found, size, slide, least):
    """The rule by its definition, window by window."""
    windows = defaultdict(list)
    for mid, uid, evid, item, second in found:
        at = NOON + second
        start = at - at % slide
        while start > at - size:
            windows[start, mid].append((uid, evid, item))
            start -= slide
    profile = {}
    for key, inside in windows.items():
        got = [(u, i) for u, e, i in inside if e == "coupon"]
        profile[key] = (
            len({u for u, _ in got if u is not None}),
            len({i for _, i in got if i is not None}),
            len(inside),
            any(e == "clickItem" for _, e, _ in inside),
        )
    alert = {k: v[:3] for k, v in profile.items() if v[0] >= least and not v[3]}
    return profile, alert, windows


def random_events(seed, n=400):
    pick = random.Random(seed)
    return [
        (
            pick.choice(["hot", "hot", "a", "b", None]),
            pick.choice(["u1", "u2", "u3", "u4", None]),
            pick.choices(["coupon", "clickItem", "addCart", None], [60, 2, 10, 2])[0],
            pick.choice(["1", "2", "3", None]),
            pick.randrange(-4000, 4000),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    "size, slide", [(300, 5), (60, 60), (90, 60), (100, 30), (20, 60), (600, 45)]
)
def test_against_the_definition(spark, size, slide):
    found = random_events(size * 1000 + slide)
    frame = events(spark, *found).cache()
    profile, alert, _ = direct(found, size, slide, 3)
    start = F.unix_seconds("window_start").alias("s")
    got = alerts.device_profiles(frame, size, slide).select(
        start, "mid", "coupon_uids", "coupon_items", "events", "clicked"
    )
    assert {(r[0], r[1]): tuple(r)[2:] for r in got.collect()} == profile
    got = alerts.coupon_alerts(frame, size, slide).select(
        start, "mid", "coupon_uids", "coupon_items", "events"
    )
    # a device without an id raises no alert: there is nobody to name
    named = {k: v for k, v in alert.items() if k[1] is not None}
    assert {(r[0], r[1]): tuple(r)[2:] for r in got.collect()} == named


def test_documents_hold_every_member(spark):
    size, slide = 600, 60
    found = random_events(7)
    frame = events(spark, *found).cache()
    _, alert, windows = direct(found, size, slide, 3)
    raised = alerts.coupon_alerts(frame, size, slide)
    got = defaultdict(list)
    for r in alerts.alert_documents(frame, raised, size, slide).collect():
        got[(r["ts"] // 1000 - size, r["mid"])].append((r["kind"], str(r["value"]), r["n"]))
    named = [k for k in alert if k[1] is not None]
    assert set(got) == set(named)
    for key in named:
        count = Counter(("event", str(e)) for _, e, _ in windows[key])
        coupon = [(u, i) for u, e, i in windows[key] if e == "coupon"]
        count.update(("uid", str(u)) for u, _ in coupon if u is not None)
        count.update(("item", str(i)) for _, i in coupon if i is not None)
        assert sorted(got[key]) == sorted((*k, n) for k, n in count.items())


def test_empty(spark):
    none = events(spark, *coupons("m", "abc")).limit(0)
    assert rows(alerts.coupon_alerts(none)) == []
    assert rows(alerts.device_profiles(none)) == []


def test_stored_panes_are_judged_as_the_batches_brought_them(spark, tmp_path):
    size, slide = 60, 20
    rng = random.Random(7)
    kinds, items = ["coupon"] * 6 + ["clickItem", "addCart", None], ["i", "j", None]
    found = [(rng.choice("mn"), rng.choice("abcd"), rng.choice(kinds), rng.choice(items), rng.randrange(900)) for _ in range(400)]
    frame = events(spark, *found)
    # every event comes in one of three batches, so most members of a pane have several rows
    path, batch = str(tmp_path / "panes"), F.pmod(F.xxhash64("*"), F.lit(3))
    for number in range(3):
        counts = alerts.bucket_counts(frame.filter(batch == number), size, slide)
        counts.write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() > stored.drop("n").distinct().count()
    raised, documents = alerts.bucket_alerts(stored, size, slide)
    expected = alerts.coupon_alerts(frame, size, slide).cache()
    assert expected.count() > 0
    assert rows(raised.drop("bucket")) == rows(expected)
    assert rows(documents.drop("bucket")) == rows(alerts.alert_documents(frame, expected, size, slide))
    # what is sorted by pane are accounts and items: events, most of the rows, are left out by its scan
    assert "Not(EqualTo(kind,event))" in plan(raised)
    raised.unpersist()
