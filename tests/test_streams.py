"""Streams fed in several batches against their batch twins."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import Window, functions as F, types as T

from helpers import plan, rows
from retailtide import streaming
from retailtide.operators import alerts as alert_ops
from retailtide.operators.orders import enrich_orders
from retailtide.operators.sales import sale_lines
from retailtide.operators.visits import first_visits, with_log_time
from retailtide.plans import entities as ent, streams
from retailtide.schemas import ORDER, SALE_COLUMNS, USER, VISIT_COLUMNS
from retailtide.session import work_folder
from retailtide.sinks import KeyedTable
from retailtide.sources import file_stream, replay_bounded, replay_in_order

FILES = 4


def replay(spark, frame, order, tmp_path, files=FILES):
    """``frame`` as a stream of ``files`` files in the order of a column.

    The source takes files by their time, so they are written one after another.
    """
    folder = str(tmp_path / uuid.uuid4().hex)
    slices = Window.orderBy(order)
    cut = frame.withColumn("_slice", F.ntile(files).over(slices)).cache()
    for number in range(1, files + 1):
        part = cut.filter(F.col("_slice") == number).drop("_slice").coalesce(1)
        part.write.mode("append").parquet(folder)
    cut.unpersist()
    return file_stream(spark, folder, frame.schema, files_per_trigger=1)


def test_visits(spark, small_dir, tmp_path):
    events = ent.table(spark, small_dir, "events")
    stream = replay(spark, events, "ts", tmp_path)
    visits = streaming.visit_table(str(tmp_path / "visits"))
    streaming.drain(
        streaming.visit_stream(
            ent.startup_log(stream), visits, str(tmp_path / "cp"), ("event_id",)
        )
    )
    batch = first_visits(ent.startup_log(events), ["event_id"]).select(*VISIT_COLUMNS)
    assert rows(visits.read(spark)) == rows(batch)
    visits.compact(spark)
    assert rows(visits.read(spark)) == rows(batch)


def test_visits_in_any_order_keep_the_earliest(spark, small_dir, tmp_path):
    events = ent.table(spark, small_dir, "events")
    stream = replay(spark, events, "value", tmp_path)
    visits = streaming.visit_table(str(tmp_path / "visits"))
    streaming.drain(
        streaming.visit_stream(
            ent.startup_log(stream), visits, str(tmp_path / "cp"), ("event_id",)
        )
    )
    batch = first_visits(ent.startup_log(events), ["event_id"]).select(*VISIT_COLUMNS)
    assert rows(visits.read(spark)) == rows(batch)


def test_a_filter_on_the_day_prunes_the_visit_table(spark, small_dir, tmp_path):
    visits = streaming.visit_table(str(tmp_path / "visits"))
    logs = first_visits(ent.startup_log(ent.table(spark, small_dir, "events")), ["event_id"])
    visits.upsert(logs, 0)
    visits.compact(spark)
    one = visits.read(spark).filter(F.col("log_date") == F.lit("2024-01-15").cast("date"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        assert re.search(r"PartitionFilters: \[[^]]*\(log_date#\d+ = 2024-01-15\)", plan(one))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert one.count() == 11


def sale_frames(spark, sf_dir):
    orders = ent.order_info(ent.table(spark, sf_dir, "orders"))
    details = ent.order_detail(ent.table(spark, sf_dir, "lineitem"), ent.table(spark, sf_dir, "part"))
    return orders, details, ent.user_info(ent.table(spark, sf_dir, "customer"))


@pytest.mark.parametrize("salts", [1, 3])
def test_sale_lines(spark, small_dir, tmp_path, salts):
    orders, details, users = sale_frames(spark, small_dir)
    batch = sale_lines(enrich_orders(orders), details, users, ent.AS_OF, columns=SALE_COLUMNS)
    table = streaming.sale_table(str(tmp_path / "sales"), ())
    streaming.drain(
        streaming.sale_stream(
            replay(spark, orders, "order_ts", tmp_path),
            replay(spark, details, "detail_ts", tmp_path),
            lambda _: users,
            table,
            str(tmp_path / "cp"),
            delay="12 hours",
            as_of=ent.AS_OF,
            salts=salts,
        )
    )
    assert rows(table.read(spark)) == rows(batch)


def test_a_replay_in_order_keeps_an_hour_of_state(spark, small_dir, tmp_path):
    orders, details, users = sale_frames(spark, small_dir)
    batch = sale_lines(enrich_orders(orders), details, users, ent.AS_OF, columns=SALE_COLUMNS)
    feeds = replay_in_order({"o": (orders, "order_ts"), "d": (details, "detail_ts")}, str(tmp_path / "in"), 12)
    table = streaming.sale_table(str(tmp_path / "sales"), ())
    job = streaming.sale_stream(feeds["o"], feeds["d"], lambda _: users, table, str(tmp_path / "cp"), "1 minute", 600, ent.AS_OF, 1)
    runs = streaming.drain_each(job, feeds.arrivals())
    progress = [p for run in runs for p in run.recentProgress if p["stateOperators"]]
    assert sum(p["numInputRows"] > 0 for p in progress) >= 4
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    removed = sum(p["stateOperators"][0]["numRowsRemoved"] for p in progress)
    total = orders.count() + details.count()
    # a slice and the minutes before it, not the whole of both feeds
    assert max(kept) < 0.6 * total and kept[-1] < 0.25 * total and removed > 0.7 * total
    near = F.abs(F.unix_seconds("order_ts") - F.unix_seconds("detail_ts")) <= 600
    met = orders.select(F.col("id").alias("order_id"), "order_ts").join(details, "order_id").filter(near)
    assert 0 < met.count() < batch.count()
    assert rows(table.read(spark).select("order_detail_id")) == rows(met.select(F.col("id").alias("order_detail_id")))


def test_a_slice_of_a_replay_is_a_batch_of_many_files(spark, tmp_path):
    times = [0, 5, 10, 11, 12, 13, 14, 95, 100, None]
    # slices of 11 seconds, some of them without rows
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, at long").repartition(4, "id")
    feed = replay_in_order({"t": (frame, "at"), "none": (frame.filter("id < 0"), "at")}, str(tmp_path / "in"), 10)
    seen = []

    def note(batch, number):
        seen.append(sorted(row["id"] for row in batch.collect()))

    job = feed["t"].unionByName(feed["none"]).writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(note)
    runs = streaming.drain_each(job, feed.arrivals())
    assert len(runs) == 10 and [ids for ids in seen if ids] == [[0, 1, 2, 9], [3, 4, 5, 6], [7], [8]]
    assert len(list((tmp_path / "in" / "t").glob("*.parquet"))) > len(seen)


def test_first_days_move_to_earlier_ones(spark, tmp_path):
    devices = streaming.device_table(str(tmp_path))
    day = lambda n: dt.date(2024, 1, n)
    batches = [[("a", 5), ("b", 5), ("a", 7)], [("a", 3), ("c", 5), (None, 2)], [("a", 4), ("b", 9), ("c", 5), (None, 1)]]
    for number, found in enumerate(batches):
        frame = spark.createDataFrame([(m, day(d)) for m, d in found], "mid string, log_date date")
        devices.add(frame, number)
        if number == 1:
            devices.add(frame, number)  # run again
            devices.seen.compact(spark)
            devices.new.compact(spark)
    new = {d: sorted(str(r[0]) for r in devices.new_on(spark, str(day(d))).collect()) for d in range(1, 10)}
    assert {d: m for d, m in new.items() if m} == {1: ["None"], 3: ["a"], 5: ["b", "c"]}


def at(seconds):
    return dt.datetime(2019, 8, 18, 12) + dt.timedelta(seconds=seconds)


def order_rows(spark, *found):
    return spark.createDataFrame(
        [(i, "O", "2019-08-18 09:05:00", "1301", "u", at(s)) for i, s in found],
        "id string, order_status string, create_time string, consignee_tel string, "
        "user_id string, order_ts timestamp",
    )


def detail_rows(spark, *found):
    return spark.createDataFrame(
        [(i, o, "s", "red gear", "2.5", at(s)) for i, o, s in found],
        "id string, order_id string, sku_id string, sku_name string, order_price string, "
        "detail_ts timestamp",
    )


def test_each_detail_meets_its_order_once_in_either_order(spark, tmp_path):
    orders = order_rows(spark, ("late", 0), ("early", 0), ("again", 0), ("again", 9), ("gone", 0))
    details = detail_rows(
        spark,
        ("a", "late", -3600),
        ("b", "early", 3600),
        ("c", "again", 4),
        ("d", "gone", 3601),
        ("e", "gone", -3601),
        ("f", "none", 0),
    )
    users = spark.createDataFrame(
        [("u", "M", "2000-01-01", "2")],
        "id string, gender string, birthday string, user_level string",
    )
    table = streaming.sale_table(str(tmp_path / "sales"))
    streaming.drain(
        streaming.sale_stream(
            replay(spark, orders, "order_ts", tmp_path, 2),
            replay(spark, details, "detail_ts", tmp_path, 3),
            lambda _: users,
            table,
            str(tmp_path / "cp"),
            delay="3 hours",
            as_of="2019-08-18",
        )
    )
    found = table.read(spark)
    assert sorted(r["order_detail_id"] for r in found.collect()) == ["a", "b", "c"]
    assert {r["user_gender"] for r in found.collect()} == {"M"}


@pytest.mark.parametrize("order", ["event_ts", "itemid"])
def test_alerts_in_any_order(spark, small_dir, tmp_path, order):
    size, slide = 24 * 3600, 3600
    events = ent.event_info(ent.table(spark, small_dir, "events"), users=3)
    table = streaming.alert_table(str(tmp_path / "alerts"))
    stream = replay(spark, events, order, tmp_path)
    streaming.drain(streaming.alert_stream(stream, table, str(tmp_path / "cp"), size, slide, uids=2))
    batch = alert_ops.latest_alerts(alert_ops.coupon_alerts(events, size, slide, uids=2))
    assert batch.count() > 0
    assert rows(table.read(spark)) == rows(batch)
    assert rows(table.documents(spark)) == rows(alert_ops.alert_documents(events, batch.cache(), size, slide))


def test_folding_panes_changes_no_alert(spark, small_dir, tmp_path):
    size, slide = 24 * 3600, 3600
    events = ent.event_info(ent.table(spark, small_dir, "events"), users=3)
    table = streaming.AlertTable(str(tmp_path / "alerts"), fold_every=2)
    stream = replay(spark, events, "itemid", tmp_path, 7)
    streaming.drain(streaming.alert_stream(stream, table, str(tmp_path / "cp"), size, slide, uids=2))
    batch = alert_ops.latest_alerts(alert_ops.coupon_alerts(events, size, slide, uids=2))
    assert rows(table.read(spark)) == rows(batch)
    assert rows(table.documents(spark)) == rows(alert_ops.alert_documents(events, batch.cache(), size, slide))
    # files of a day: those of its live version and of the one before
    for part in ("panes", "judged"):
        base = tmp_path / "alerts" / part / "base"
        assert all(len(list(span.glob("version=*"))) <= 2 for span in base.iterdir())
        assert len(list((tmp_path / "alerts" / part / "changes").iterdir())) <= 2


def test_a_batch_reads_panes_of_its_own_time(spark, tmp_path):
    day = 86_400
    table = streaming.alert_table(str(tmp_path / "alerts"))
    for batch, first in enumerate((0, 40 * day, 41 * day)):
        events = spark.createDataFrame(
            [("m", u, "coupon", "i", at(first + s)) for u in "abc" for s in (0, 7200)],
            "mid string, uid string, evid string, itemid string, event_ts timestamp",
        )
        attempt = table.panes.append(alert_ops.bucket_counts(events, 300, 300), batch)
    brought = table.panes.brought(spark, 2, attempt)
    touched = brought.select("bucket").distinct()
    held = table.held(spark, touched)
    assert rows(held.drop("span", "batch_id")) == rows(brought.drop("batch_id"))
    assert table.panes.versions(spark).count() == 3 * held.count()
    # files of other days are told by their range of buckets; no part without rows takes tasks
    low = min(row[0] for row in touched.collect()) // day * day
    assert f"GreaterThanOrEqual(bucket,{low})" in plan(held)
    stored = {name.rsplit("/", 1)[-1] for name in held.inputFiles() if "/changes/" in name}
    own = {row[0] for row in brought.select(F.input_file_name()).distinct().collect()}
    assert all((name in plan(held)) == any(path.endswith(name) for path in own) for name in stored)
    assert "ExistingRDD" not in plan(held)


def test_old_panes_go_and_late_events_of_those_days_are_left_out(spark, tmp_path):
    day = 86_400
    batches = [[("m", u, 0) for u in "abc"], [("m", u, 40 * day) for u in "abc"], [("m", "d", 1), ("n", "e", 40 * day)]]
    schema = "mid string, uid string, evid string, itemid string, event_ts timestamp"
    folder = str(tmp_path / "in")
    for events in batches:
        frame = spark.createDataFrame([(m, u, "coupon", "i", at(s)) for m, u, s in events], schema)
        frame.coalesce(1).write.mode("append").parquet(folder)
    stream = file_stream(spark, folder + "/", spark.createDataFrame([], schema).schema, files_per_trigger=1)
    table = streaming.AlertTable(str(tmp_path / "alerts"), keep_seconds=7 * day, fold_every=2)
    streaming.drain(streaming.alert_stream(stream, table, str(tmp_path / "cp"), 300, 300))
    table.panes.fold_in(spark)
    panes = table.panes.versions(spark)
    # the panes of the first day went; its alert stays, and the late event did not touch it
    assert panes.agg(F.min("span")).first()[0] > at(30 * day).timestamp()
    found = sorted((r["mid"], r["coupon_uids"], r["window_start"]) for r in table.read(spark).collect())
    assert found == [("m", 3, at(0)), ("m", 3, at(40 * day))]


def test_orders_and_users(spark, small_dir, tmp_path):
    names = ["id", "user_id", "order_status", "total_amount", "consignee_tel", "create_time"]
    orders = ent.order_info(ent.table(spark, small_dir, "orders"))
    table = streaming.order_table(
        str(tmp_path / "orders"), T.StructType([ORDER[n] for n in names]), ()
    )
    stream = replay(spark, orders, "order_ts", tmp_path)
    streaming.drain(streaming.order_stream(stream.select(*names), table, str(tmp_path / "cp"), ("create_time",)))
    assert rows(table.read(spark)) == rows(enrich_orders(orders.select(*names)))

    users = streaming.user_table(str(tmp_path / "users"))
    feed = spark.createDataFrame(
        [("1", "n", str(v), "2000-01-01", "M", v) for v in range(8)],
        "id string, login_name string, user_level string, birthday string, gender string, v int",
    )
    streaming.drain(
        streaming.user_stream(
            replay(spark, feed, "v", tmp_path), users, str(tmp_path / "cp2"), ("v",)
        )
    )
    assert [r["user_level"] for r in users.read(spark).collect()] == ["7"]


def test_only_the_buyers_of_a_batch_are_read(spark, tmp_path):
    users = streaming.user_table(str(tmp_path / "users"))
    feed = spark.createDataFrame(
        [(i, "n", "1", "2000-01-01", "M") for i in "abc"],
        "id string, login_name string, user_level string, birthday string, gender string",
    )
    users.upsert(feed, 0, unique=True)
    wanted = spark.createDataFrame([("a",), ("z",), (None,)], "id string")
    assert [r["id"] for r in streaming.users_in(users)(wanted).collect()] == ["a"]


# ---- keyed tables --------------------------------------------------------

PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def pairs(spark, *found):
    return spark.createDataFrame(list(found), PAIR)


def test_later_batches_win_and_a_batch_can_be_run_again(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",))
    assert rows(table.read(spark)) == []
    table.upsert(pairs(spark, ("a", 1), ("b", 1)), 0, unique=True)
    table.upsert(pairs(spark, ("a", 2)), 1, unique=True)
    table.upsert(pairs(spark, ("a", 2)), 1, unique=True)
    table.upsert(pairs(spark), 2, unique=True)
    assert rows(table.read(spark)) == [("a", 2), ("b", 1)]
    table.compact(spark)
    table.upsert(pairs(spark, ("b", 3), ("c", 3)), 3, unique=True)
    assert rows(table.read(spark)) == [("a", 2), ("b", 3), ("c", 3)]
    table.compact(spark)
    assert rows(table.read(spark)) == [("a", 2), ("b", 3), ("c", 3)]


def test_order_decides_before_the_batch(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",), order=(F.col("v").asc(),))
    table.upsert(pairs(spark, ("a", 2), ("a", 5)), 0)
    table.upsert(pairs(spark, ("a", 3)), 1)
    assert rows(table.read(spark)) == [("a", 2)]


def test_an_unfinished_compaction_is_ignored(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",))
    table.upsert(pairs(spark, ("a", 1)), 0, unique=True)
    table.upsert(pairs(spark, ("a", 2)), 1, unique=True)
    table.compact(spark)
    # the base is written, its manifest is not complete
    (tmp_path / "manifest" / "1" / "_SUCCESS").unlink()
    assert rows(table.read(spark)) == [("a", 2)]
    table.upsert(pairs(spark, ("b", 3)), 2, unique=True)
    table.compact(spark)
    assert rows(table.read(spark)) == [("a", 2), ("b", 3)]


def test_an_unfinished_change_is_ignored(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",))
    table.upsert(pairs(spark, ("a", 1)), 0, unique=True)
    table.upsert(pairs(spark, ("a", 2), ("z", 2)), 1, unique=True)
    (mark,) = (tmp_path / "commits" / "0").glob("1-*")
    mark.unlink()
    assert rows(table.read(spark)) == [("a", 1)]
    # the batch runs again, with other rows: nothing of the first attempt shows
    table.upsert(pairs(spark, ("a", 3)), 1, unique=True)
    assert rows(table.read(spark)) == [("a", 3)]


def test_batches_compact_the_table_and_remove_what_is_covered(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",), compact_every=2, buckets=4)
    for n in range(7):
        table.upsert(pairs(spark, ("a", n), (f"b{n}", n)), n, unique=True)
    assert rows(table.read(spark)) == sorted([("a", 6)] + [(f"b{n}", n) for n in range(7)])
    assert sorted(p.name for p in (tmp_path / "manifest").iterdir()) == ["3", "5"]
    assert sorted(p.name for p in (tmp_path / "changes").iterdir()) == ["2", "3"]
    # of every bucket there are at most the live version and the one before
    assert all(len(list(b.glob("version=*"))) <= 2 for b in (tmp_path / "base").iterdir())


def test_many_batches_are_one_flat_folder(spark, tmp_path):
    table = KeyedTable(str(tmp_path), PAIR, ("k",), compact_every=0)
    for n in range(30):
        table.upsert(pairs(spark, ("a", n), (f"b{n % 7}", n)), n, unique=True)
    assert [p.name for p in (tmp_path / "changes").iterdir()] == ["0"]
    assert not [p for p in (tmp_path / "changes" / "0").iterdir() if p.is_dir()]
    assert len(list((tmp_path / "commits" / "0").glob("[0-9]*"))) == 30
    assert rows(table.read(spark)) == [("a", 29), *sorted((f"b{n % 7}", n) for n in range(23, 30))]


def test_only_touched_cells_are_read_and_written(spark, tmp_path):
    day = T.StructField("day", T.DateType())
    schema = T.StructType([day, *PAIR.fields])
    table = KeyedTable(str(tmp_path), schema, ("day", "k"), partition_by=("day",), buckets=8)
    first = spark.range(4000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("day"),
        F.col("id").cast("string").alias("k"),
        F.lit(0).alias("v"),
    )
    table.upsert(first, 0, unique=True)
    table.compact(spark)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "base").rglob("*.parquet")}
    one = first.filter("k = '50'")
    table.upsert(one.withColumn("v", F.lit(1)), 1, unique=True)
    table.compact(spark)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "base").rglob("*.parquet")}
    new = set(after) - set(files)
    assert len(new) == 1 and all(after[p] == files[p] for p in files)
    assert spark.read.parquet(*map(str, new)).count() < 40  # of 4,000
    assert table.read(spark).filter("v = 1").count() == 1 and table.read(spark).count() == 4000


def test_odd_partition_values_survive_a_fold(spark, tmp_path):
    schema = T.StructType([T.StructField("d", T.StringType()), *PAIR.fields])
    table = KeyedTable(str(tmp_path), schema, ("d", "k"), partition_by=("d",), buckets=2)
    found = [("a/b=c", "k", 1), (None, "k", 2), ("x y:%", None, 3), ("2024-01-01", "k", 4)]
    for n in range(2):
        table.upsert(spark.createDataFrame([(d, k, v + 10 * n) for d, k, v in found], schema), n, unique=True)
        table.compact(spark)
    assert rows(table.read(spark)) == rows(spark.createDataFrame([(d, k, v + 10) for d, k, v in found], schema))


def test_a_look_up_reads_its_buckets_alone(spark, tmp_path):
    users = streaming.user_table(str(tmp_path / "users"))
    feed = spark.range(500).select(
        F.col("id").cast("string").alias("id"), *[F.lit("x").alias(n) for n in USER.names if n != "id"]
    )
    users.upsert(feed, 0, unique=True)
    users.compact(spark)
    wanted = spark.createDataFrame([(7,), (9000,)], "id bigint")  # of another type than the stored ids
    found = streaming.users_in(users)(wanted.select(F.col("id").cast("string").alias("id")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        text = plan(found)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert [r["id"] for r in found.collect()] == ["7"]
    read = set(re.findall(r"/bucket=(\d+)/", text))
    assert 1 <= len(read) <= 2


def test_a_batch_with_repeated_keys_needs_an_order(spark, tmp_path):
    with pytest.raises(ValueError, match="order"):
        KeyedTable(str(tmp_path), PAIR, ("k",)).upsert(pairs(spark, ("a", 1)), 0)


def test_late_and_far_ahead_visits_are_kept(spark, tmp_path):
    day = 86_400_000
    found = [("a", 30 * day + 5), ("far", 900 * day), ("b", 28 * day), ("c", None), ("a", 30 * day + 2), ("d", 30 * day)]
    schema = "mid string, ts bigint"
    for n, row in enumerate(found):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    logs = with_log_time(file_stream(spark, f"{tmp_path}/in/", spark.createDataFrame([], schema).schema, files_per_trigger=1))
    others = [F.lit(None).cast("string").alias(c) for c in VISIT_COLUMNS if c not in logs.columns]
    visits = streaming.visit_table(str(tmp_path / "visits"))
    streaming.drain(streaming.visit_stream(logs.select("*", *others), visits, str(tmp_path / "cp")))
    got = sorted((r["mid"], r["ts"]) for r in visits.read(spark).collect())
    assert got == [("a", 30 * day + 2), ("b", 28 * day), ("d", 30 * day), ("far", 900 * day)]


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_a_run_does_not_take_in_what_earlier_runs_changed(spark, small_dir, tmp_path):
    orders, details, users = sale_frames(spark, small_dir)
    feeds = replay_in_order({"o": (orders, "order_ts"), "d": (details, "detail_ts")}, str(tmp_path / "in"), 3)
    table = streaming.sale_table(str(tmp_path / "sales"), ())
    job = streaming.sale_stream(feeds["o"], feeds["d"], lambda _: users, table, str(tmp_path / "cp"), as_of=ent.AS_OF, salts=1)
    key = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(key)
    streaming.drain_each(job, feeds.arrivals())
    assert spark.conf.get(key) == before == "true"
    # each version is a snapshot; changes are what a later run would take in again, one by one
    state = [path.suffix for path in (tmp_path / "cp" / "state").rglob("*") if path.is_file()]
    assert ".zip" in state and ".changelog" not in state


def test_bounded_slices_hold_equal_numbers_of_rows(spark, tmp_path):
    # most rows lie in one part of the time, some in one second, some have none
    times = [n for n in range(900)] + [1_000_000, 9_000_000] + [500] * 40 + [None] * 3
    frame = spark.createDataFrame(list(enumerate(times)), "id int, at long").repartition(4, "id")
    few = spark.createDataFrame([(-1, 100), (-2, 9_000_000)], "id int, at long")
    feed = replay_bounded({"t": (frame, "at"), "few": (few, "at"), "none": (few.filter("id > 0"), "at")}, str(tmp_path / "in"), 4, 100)
    seen, there = [], []

    def note(batch, number):
        seen.append(sorted((-1 if row["at"] is None else row["at"], row["id"]) for row in batch.collect()))
        there.append(len(list((tmp_path / "in" / "live").iterdir())))

    job = feed["t"].unionByName(feed["few"]).unionByName(feed["none"]).writeStream
    conf = dict(spark.conf.getAll)
    streaming.follow(job.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(note), feed.arrivals(), 2)
    assert dict(spark.conf.getAll) == conf
    seen = [part for part in seen if part]
    assert len(seen) >= 9 and max(map(len, seen)) <= 150 and set(there) == {1}
    assert sorted(row for part in seen for row in part) == sorted([(-1 if t is None else t, n) for n, t in enumerate(times)] + [(100, -1), (9_000_000, -2)])
    # a feed's slice may come a batch after that of another; in each the time goes on
    for mine in (lambda n: n >= 0, lambda n: n < 0):
        ends = [[at for at, n in part if mine(n)] for part in seen]
        ends = [(min(part), max(part)) for part in ends if part]
        assert all(before[1] < after[0] for before, after in zip(ends, ends[1:]))


def test_bounded_slices_of_no_rows_or_one(spark, tmp_path):
    none = spark.createDataFrame([], "id int, at long")
    for number, frame in enumerate([none, spark.createDataFrame([(1, None)], none.schema), spark.createDataFrame([(1, 5)] * 9, none.schema)]):
        feed = replay_bounded({"t": (frame, "at")}, str(tmp_path / f"in{number}"), 2, 4)
        job = feed["t"].writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"cp{number}"))
        streaming.follow(job.option("path", str(tmp_path / f"out{number}")), feed.arrivals(), 2)
        assert spark.read.schema(none.schema).parquet(str(tmp_path / f"out{number}")).count() == frame.count()


def test_batches_of_the_sale_replay_do_not_grow_with_the_tables(spark, small_dir, monkeypatch):
    orders, details, users = sale_frames(spark, small_dir)
    users = users.join(ent.user_info(ent.without_debt(ent.table(spark, small_dir, "customer"))).select("id"), "id", "left_semi")
    batch = sale_lines(enrich_orders(orders), details, users, ent.AS_OF, columns=SALE_COLUMNS)
    runs, drain, follow = [], streaming.run.drain, getattr(streaming, "follow", None)
    monkeypatch.setattr(streaming.run, "drain", lambda writer: runs.append(drain(writer)) or runs[-1])
    if follow:
        monkeypatch.setattr(streaming, "follow", lambda *given: runs.append(follow(*given)))
    monkeypatch.setattr(streams, "BATCH_ROWS", 1000, raising=False)
    found = streams.QUERIES["sale_stream"](spark, small_dir)
    taken = [p["numInputRows"] for run in runs for p in run.recentProgress]
    assert sum(taken) == orders.count() + details.count() > 7000
    assert max(taken) <= 1200
    assert rows(found.select(*SALE_COLUMNS)) == rows(batch)
