"""Coupon-abuse alerts: one device, several accounts, no item looked at.

A sliding window of 300 s every 5 s holds each event 60 times. The batch form
never makes those copies: it counts per pane, notes for each account, item and
event in which run of windows it is, and turns the starts and ends of the runs
into running totals per device. Only the windows of the answer are written out.
The alerts also drop every device that cannot reach the threshold first.

What a window holds of a device is kept in long form, one "member" row per
distinct account, item and event type, so no device is ever gathered in one
array or one task on the way.
"""

from __future__ import annotations

from math import ceil, gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from .latest import latest_by_key

# The rule's window, step and threshold, and the two event types.
WINDOW_SECONDS = 300
SLIDE_SECONDS = 5
MIN_UIDS = 3
COUPON = "coupon"
CLICK = "clickItem"

MEMBER = ["mid", "kind", "value"]

# Tasks that share one device's raw events of a bucket.
DEVICE_SALTS = 16


def members(events: DataFrame, *keep: str) -> DataFrame:
    """Long form: each event's type, and a coupon's account and item.

    Missing accounts and items are no members. Columns (*keep, mid, kind, value).
    """
    coupon = F.col("evid") == COUPON

    def member(kind: str, value: str, when: Column) -> Column:
        return F.struct(F.when(when, F.lit(kind)).alias("kind"), F.col(value).alias("value"))

    kinds = F.array(
        member("event", "evid", F.lit(True)),
        member("uid", "uid", coupon & F.col("uid").isNotNull()),
        member("item", "itemid", coupon & F.col("itemid").isNotNull()),
    )
    rows = events.select(*keep, "mid", F.inline(kinds))
    return rows.filter(F.col("kind").isNotNull())


def profile(windowed: DataFrame, *keys: Column | str) -> DataFrame:
    """Member rows of a window to one row per key: sizes of the sets and the flag.

    The form for streams, where runs of windows cannot be looked back on.
    """
    kind, value = F.col("kind"), F.col("value")
    return windowed.groupBy(*keys).agg(
        F.count_if(kind == "uid").alias("coupon_uids"),
        F.count_if(kind == "item").alias("coupon_items"),
        F.sum(F.when(kind == "event", F.col("n")).otherwise(0)).alias("events"),
        F.max(F.coalesce((kind == "event") & (value == CLICK), F.lit(False))).alias("clicked"),
    )


def is_alert(uids: int = MIN_UIDS) -> Column:
    return (F.col("coupon_uids") >= uids) & ~F.col("clicked")


def alert_id(mid: Column, ts_ms: Column) -> Column:
    """Device and minute: alerts of one minute share an id, the later one stays."""
    return F.concat_ws("_", mid, F.floor(ts_ms / F.lit(60_000)).cast("string"))


def _down(at: Column, step: int) -> Column:
    """The last multiple of ``step`` not after ``at``."""
    return at - F.pmod(at, F.lit(step).cast("bigint"))


class _Slices:
    """Panes, window starts and buckets, all in epoch seconds.

    A bucket is a run of window starts about one window long. A pane belongs to
    at most two buckets, and a bucket has at most twice the panes of a window:
    that bounds the rows of one member which meet in one task.
    """

    def __init__(self, size: int, slide: int):
        self.slide = slide
        self.pane = gcd(size, slide)
        self.bucket = ceil(size / slide) * slide
        self.gaps = slide > size
        at = F.col("pane")
        self.first = _down(at - size, slide) + slide
        self.last = _down(at, slide)

    def with_pane(self, events: DataFrame) -> DataFrame:
        seconds = F.unix_seconds(F.col("event_ts").cast("timestamp"))
        placed = events.withColumn("pane", _down(seconds, self.pane))
        # with gaps between the windows some panes are in none
        return placed.filter(self.first <= self.last) if self.gaps else placed

    def with_bucket(self, panes: DataFrame) -> DataFrame:
        low, high = _down(self.first, self.bucket), _down(self.last, self.bucket)
        reach = F.sequence(low, high, F.lit(self.bucket).cast("bigint"))
        return panes.withColumn("bucket", F.explode(reach))

    def counts(self, events: DataFrame) -> DataFrame:
        """(bucket, pane, member, n), the map side summing first.

        ``events`` carry a pane, and a bucket if they were chosen by it.
        """
        keys = [name for name in ("bucket", "pane") if name in events.columns]
        counted = members(events, *keys).groupBy(*keys, *MEMBER).agg(F.count("*").alias("n"))
        return counted if "bucket" in keys else self.with_bucket(counted)

    def of_devices(self, events: DataFrame, places: DataFrame) -> DataFrame:
        """Events of the devices and buckets in ``places``.

        These are raw events, and one device may send most of them: the salt
        spreads a device over several tasks, each with its copy of ``places``.
        """
        spread = F.pmod(F.xxhash64("event_ts", "uid", "itemid"), F.lit(DEVICE_SALTS)).cast("int")
        placed = self.with_bucket(self.with_pane(events)).withColumn("salt", spread)
        salts = F.explode(F.array(*map(F.lit, range(DEVICE_SALTS))))
        chosen = placed.join(places.withColumn("salt", salts), ["bucket", "mid", "salt"], "left_semi")
        return chosen.drop("salt")

    def _reach(self) -> tuple[Column, Column]:
        """First and last window start of a pane within its bucket."""
        end = F.col("bucket") + (self.bucket - self.slide)
        return F.greatest(self.first, F.col("bucket")), F.least(self.last, end)

    def _starts(self, first: Column, last: Column) -> Column:
        return F.explode(F.sequence(first, last, F.lit(self.slide).cast("bigint")))

    def windows(self, counts: DataFrame) -> DataFrame:
        """(window_start, member, n): every window's members, written out."""
        # The keys of this shuffle are among the keys of the grouping, so the
        # expanded rows are summed where they are.
        spread = counts.repartition("bucket", *MEMBER)
        return (
            spread.select("bucket", *MEMBER, "n", self._starts(*self._reach()).alias("window_start"))
            .groupBy("bucket", "window_start", *MEMBER)
            .agg(F.sum("n").alias("n"))
            .select("window_start", *MEMBER, "n")
        )

    def _runs(self, counts: DataFrame, stored: bool) -> DataFrame:
        """Member rows, each with the run of windows, ``begin`` to ``last``, that it adds to."""
        first, last = self._reach()
        # An account is counted in a window once, by its first pane there: a later
        # pane adds only the windows the one before did not reach. At most twice
        # a window's panes meet here.
        member = Window.partitionBy("bucket", *MEMBER).orderBy("pane")
        later = F.greatest(first, F.lag(last).over(member) + self.slide)
        is_event = F.col("kind") == "event"

        def runs(rows: DataFrame, begin: Column) -> DataFrame:
            placed = rows.select("bucket", "mid", "kind", "value", "n", begin.alias("begin"), last.alias("last"))
            return placed.filter(F.col("begin") <= F.col("last"))

        if stored:
            # most rows are events, and these need not meet
            return runs(counts.filter(~is_event), later).unionByName(runs(counts.filter(is_event), first))
        return runs(counts, F.when(is_event, first).otherwise(later))

    def profiles(self, counts: DataFrame, keep: Column | None = None, stored: bool = False) -> DataFrame:
        """(window_start, mid, coupon_uids, coupon_items, events, clicked).

        ``keep`` is a test on a profile, applied before windows are written out. ``stored`` says
        that ``counts`` can be read twice at little cost. A member of a pane may have several rows.
        """
        runs = self._runs(counts, stored)
        is_event, n = F.col("kind") == "event", F.col("n")
        clicks = F.when(is_event & (F.col("value") == CLICK), n).otherwise(0)
        amounts = {
            "coupon_uids": F.when(F.col("kind") == "uid", 1).otherwise(0),
            "coupon_items": F.when(F.col("kind") == "item", 1).otherwise(0),
            "events": F.when(is_event, n).otherwise(0),
            "clicks": clicks,
        }

        def change(at: Column, sign: int) -> Column:
            signed = [(value * sign).cast("bigint").alias(name) for name, value in amounts.items()]
            return F.struct(at.alias("at"), *signed)

        changes = runs.select(
            "bucket",
            "mid",
            F.inline(F.array(change(F.col("begin"), 1), change(F.col("last") + self.slide, -1))),
        )
        # A bucket has a fixed number of window starts, so of changes per device.
        steps = (
            changes.filter(F.col("at") < F.col("bucket") + self.bucket)
            .groupBy("bucket", "mid", "at")
            .agg(*[F.sum(name).alias(name) for name in amounts])
        )
        device = Window.partitionBy("bucket", "mid").orderBy("at")
        so_far = device.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        totals = steps.select(
            "mid",
            "at",
            F.coalesce(F.lead("at").over(device), F.col("bucket") + self.bucket).alias("until"),
            *[F.sum(name).over(so_far).alias(name) for name in amounts],
        )
        held = totals.filter(F.col("events") > 0).withColumn("clicked", F.col("clicks") > 0)
        if keep is not None:
            held = held.filter(keep)
        return held.select(
            self._starts(F.col("at"), F.col("until") - self.slide).alias("window_start"),
            "mid",
            "coupon_uids",
            "coupon_items",
            "events",
            "clicked",
        )


def _window_times(rows: DataFrame, size: int) -> DataFrame:
    start = F.col("window_start")
    return rows.withColumn("window_end", F.timestamp_seconds(start + size)).withColumn(
        "window_start", F.timestamp_seconds(start)
    )


def device_profiles(
    events: DataFrame, size: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """Every (window, device) with its counts and whether an item was clicked."""
    slices = _Slices(size, slide)
    return _window_times(slices.profiles(slices.counts(slices.with_pane(events))), size)


def device_members(
    events: DataFrame, size: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS
) -> DataFrame:
    """The members behind :func:`device_profiles`, each with its count."""
    slices = _Slices(size, slide)
    return _window_times(slices.windows(slices.counts(slices.with_pane(events))), size)


def coupon_alerts(
    events: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    uids: int = MIN_UIDS,
) -> DataFrame:
    """(window, device) with at least ``uids`` coupon accounts and no click."""
    slices = _Slices(size, slide)
    # A device with too few accounts in all panes of a bucket has too few in each
    # of its windows. This looks at coupons and three columns only.
    coupons = events.filter((F.col("evid") == COUPON) & F.col("uid").isNotNull())
    able = (
        slices.with_bucket(slices.with_pane(coupons))
        .select("bucket", "mid", "uid")
        .distinct()
        .groupBy("bucket", "mid")
        .agg(F.count("*").alias("uids"))
        .filter(F.col("uids") >= uids)
    )
    counts = slices.counts(slices.of_devices(events, able))
    alerts = slices.profiles(counts, keep=is_alert(uids)).drop("clicked")
    return with_alert_id(_window_times(alerts, size))


def with_alert_id(alerts: DataFrame) -> DataFrame:
    """Add ``ts``, the window's end in milliseconds, and the id made from it."""
    stamped = alerts.withColumn("ts", F.unix_millis("window_end"))
    return stamped.withColumn("alert_id", alert_id(F.col("mid"), F.col("ts")))


def latest_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per id: the last window of the minute."""
    return latest_by_key(alerts, ["alert_id"], ["window_end"])


def alert_documents(
    events: DataFrame,
    alerts: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
) -> DataFrame:
    """(alert_id, mid, ts, kind, value, n): who and what is behind each alert.

    A document is stored in long form, one row per account, item and event type
    with its count, so its size bounds no row. ``alerts`` are stored ones: they are
    used twice.
    """
    slices = _Slices(size, slide)
    start = F.unix_seconds("window_start")
    marked = alerts.select("alert_id", "mid", "ts", start.alias("window_start"))
    bucket = _down(F.col("window_start"), slices.bucket)
    places = marked.select(bucket.alias("bucket"), "mid").distinct()
    return (
        slices.windows(slices.counts(slices.of_devices(events, places)))
        .join(marked, ["window_start", "mid"])
        .select("alert_id", "mid", "ts", "kind", "value", "n")
    )


def alert_events(
    events: DataFrame,
    alerts: DataFrame,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    tie_break: str = "event_id",
) -> DataFrame:
    """(alert_id, mid, ts, position, evid, tie_break): the events behind each alert, numbered from 1 as they came.

    Events of one time go by ``tie_break``. They are numbered pane by pane, and panes by what came
    before them in their bucket, so no more than a device's events of one pane meet in a
    task, however long the window. ``alerts`` are stored ones: they are used several times.
    """
    slices = _Slices(size, slide)
    start = F.unix_seconds("window_start")
    marked = alerts.select("alert_id", "mid", "ts", start.alias("window_start"))
    marked = marked.withColumn("bucket", _down(F.col("window_start"), slices.bucket))
    chosen = slices.of_devices(events, marked.select("bucket", "mid").distinct())
    upto = Window.unboundedPreceding
    in_pane = Window.partitionBy("bucket", "mid", "pane").orderBy("event_ts", tie_break).rowsBetween(upto, 0)
    numbered = chosen.select("bucket", "mid", "pane", "evid", tie_break, F.count("*").over(in_pane).alias("number"))
    counts = chosen.groupBy("bucket", "mid", "pane").agg(F.count("*").alias("n"))
    panes = Window.partitionBy("bucket", "mid").orderBy("pane").rowsBetween(upto, -1)
    before = counts.select("bucket", "mid", "pane", F.coalesce(F.sum("n").over(panes), F.lit(0)).alias("before"))
    inside = (F.col("pane") >= F.col("window_start")) & (F.col("pane") < F.col("window_start") + size)
    # what had come when the window began
    reached = marked.join(before, ["bucket", "mid"]).filter(inside)
    first = reached.groupBy("bucket", "mid", "window_start").agg(F.min("before").alias("base"))
    own = reached.join(first, ["bucket", "mid", "window_start"]).withColumn("skipped", F.col("before") - F.col("base"))
    found = own.join(numbered, ["bucket", "mid", "pane"])
    return found.select("alert_id", "mid", "ts", (F.col("skipped") + F.col("number")).alias("position"), "evid", tie_break)


def bucket_counts(events: DataFrame, size: int, slide: int) -> DataFrame:
    """(bucket, pane, mid, kind, value, n): what a table of panes takes in."""
    slices = _Slices(size, slide)
    return slices.counts(slices.with_pane(events)).select("bucket", "pane", *MEMBER, "n")


def bucket_alerts(
    counts: DataFrame, size: int, slide: int, uids: int = MIN_UIDS
) -> tuple[DataFrame, DataFrame]:
    """Alerts (persisted) and documents, each with its ``bucket``, of whole buckets of :func:`bucket_counts`.

    ``counts`` are stored ones, read three times; a member of a pane may have a row per batch.
    """
    slices = _Slices(size, slide)
    found = slices.profiles(counts, keep=is_alert(uids), stored=True).drop("clicked")
    bucket = _down(F.col("window_start"), slices.bucket)
    # used twice: as they are, and to pick what goes into the documents
    alerts = with_alert_id(_window_times(found.withColumn("bucket", bucket), size)).persist()
    marked = alerts.select("bucket", "alert_id", "mid", "ts", F.unix_seconds("window_start").alias("window_start"))
    able = counts.join(marked.select("bucket", "mid").distinct(), ["bucket", "mid"], "left_semi")
    documents = slices.windows(able).join(marked, ["window_start", "mid"])
    return alerts, documents.select("alert_id", "mid", "ts", "kind", "value", "n", "bucket")
