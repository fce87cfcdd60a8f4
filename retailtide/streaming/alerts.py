"""The live alert job: panes are stored, and touched stretches of time judged anew.

A batch adds its counts per pane and member to a table whose base lies by day, one file
set for all panes of a day. The buckets it touches (stretches of window starts, see
``operators.alerts``) are then judged by the batch rule over all their panes, windows still
open included. Their alerts and documents are added together, by one commit, under the
batch's number; of a bucket only the rows of its last batch count. So nothing is held in
state and an alert that a later click takes back goes again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.alerts import (
    MEMBER,
    MIN_UIDS,
    SLIDE_SECONDS,
    WINDOW_SECONDS,
    bucket_alerts,
    bucket_counts,
    latest_alerts,
)
from ..sinks import FoldedTable

# Seconds of time whose panes and alerts share a folder.
SPAN_SECONDS = 86_400


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampType()
_PANES = _schema(bucket=_LONG, pane=_LONG, mid=_TEXT, kind=_TEXT, value=_TEXT, n=_LONG)
_JUDGED = _schema(
    bucket=_LONG,
    what=_TEXT,
    alert_id=_TEXT,
    mid=_TEXT,
    ts=_LONG,
    window_start=_TIME,
    window_end=_TIME,
    coupon_uids=_LONG,
    coupon_items=_LONG,
    events=_LONG,
    kind=_TEXT,
    value=_TEXT,
    n=_LONG,
)
_SPAN = (T.StructField("span", T.LongType()),)
# What a row of the judged table is. Each touched bucket has one that only says so.
ALERT, DOCUMENT, TOUCHED = "alert", "document", "touched"


def _span() -> Column:
    return F.col("bucket") - F.pmod(F.col("bucket"), F.lit(SPAN_SECONDS).cast("long"))


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("span", _span())


def _summed(panes: DataFrame) -> DataFrame:
    return panes.groupBy("span", "bucket", "pane", *MEMBER).agg(F.sum("n").alias("n"), F.max("batch_id").alias("batch_id"))


def _last_judgement(rows: DataFrame) -> DataFrame:
    """The rows of the last batch that touched each bucket."""
    last = rows.filter(F.col("what") == TOUCHED).groupBy("bucket").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, ["bucket", "batch_id"], "left_semi")


@dataclass(frozen=True)
class AlertTable:
    """Panes, and the alerts with their documents, by day.

    ``keep_seconds`` says how far behind the latest pane one may come: at a fold, panes of
    days before that go, and later events of those days are left out. Alerts stay.
    Without it panes stay for ever and no event is too late.
    """

    path: str
    keep_seconds: int | None = None
    fold_every: int = 500

    def _kept(self, manifest: DataFrame) -> Column:
        return F.col("span") >= self._horizon(manifest)

    def _horizon(self, manifest: DataFrame) -> int:
        newest = manifest.agg(F.max("span")).first()[0]
        if newest is None or self.keep_seconds is None:
            return -(1 << 62)
        return newest - self.keep_seconds

    @property
    def panes(self) -> FoldedTable:
        keep = None if self.keep_seconds is None else self._kept
        return FoldedTable(f"{self.path}/panes", _PANES, _SPAN, _placed, _summed, self.fold_every, keep)

    @property
    def judged(self) -> FoldedTable:
        return FoldedTable(f"{self.path}/judged", _JUDGED, _SPAN, _placed, _last_judgement, self.fold_every)

    def held(self, spark: SparkSession, touched: DataFrame) -> DataFrame:
        """The panes of these buckets, not summed: a member that several batches brought has a row of each."""
        # the folders to look at, a number per day
        days = [row[0] for row in touched.select(_span()).distinct().collect()]
        # of batches that are not folded the files tell their range of buckets, but no day
        near = F.col("bucket").between(min(days, default=0), max(days, default=0) + SPAN_SECONDS - 1)
        return self.panes.versions(spark, F.col("span").isin(days), near).join(touched, "bucket", "left_semi")

    def in_time(self, counts: DataFrame) -> DataFrame:
        """The counts whose days still have all their panes."""
        if self.keep_seconds is None:
            return counts
        return counts.filter(_span() >= self._horizon(self.panes.manifest(counts.sparkSession)[1]))

    def _rows(self, spark: SparkSession, what: str) -> DataFrame:
        return _last_judgement(self.judged.versions(spark)).filter(F.col("what") == what)

    def read(self, spark: SparkSession) -> DataFrame:
        """One alert per device and minute, the last window of each."""
        alerts = latest_alerts(self._rows(spark, ALERT))
        return alerts.select(
            "alert_id", "mid", "window_start", "window_end", "coupon_uids", "coupon_items", "events", "ts"
        )

    def documents(self, spark: SparkSession) -> DataFrame:
        """(alert_id, mid, ts, kind, value, n) of these alerts, a row per member."""
        last = self.read(spark).select("alert_id", "mid", "ts")
        held = self._rows(spark, DOCUMENT).select("alert_id", "mid", "ts", "kind", "value", "n")
        return held.join(last, ["alert_id", "mid", "ts"], "left_semi")


def alert_table(path: str, keep_seconds: int | None = None) -> AlertTable:
    return AlertTable(path, keep_seconds)


def alert_stream(
    events: DataFrame,
    table: AlertTable,
    checkpoint: str,
    size: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    uids: int = MIN_UIDS,
) -> DataStreamWriter:
    """Alerts, judged at every batch. Events without a device or a time are left to the quarantine."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        usable = batch.filter(F.col("mid").isNotNull() & F.col("event_ts").isNotNull())
        attempt = table.panes.append(table.in_time(bucket_counts(usable, size, slide)), batch_id)
        touched = table.panes.brought(spark, batch_id, attempt).select("bucket").distinct().persist()
        alerts = None
        try:
            alerts, documents = bucket_alerts(table.held(spark, touched), size, slide, uids)
            marks = touched.withColumn("what", F.lit(TOUCHED))
            rows = alerts.withColumn("what", F.lit(ALERT)).unionByName(documents.withColumn("what", F.lit(DOCUMENT)), True)
            table.judged.append(rows.unionByName(marks, True), batch_id)
        finally:
            for kept in (touched, alerts):
                if kept is not None:
                    kept.unpersist()

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
