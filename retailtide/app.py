"""Command line: start a stream job, or print a dashboard answer.

    spark-submit retailtide/app.py run visits --brokers host:9092 --tables /shared/tables
    spark-submit retailtide/app.py run visits --folder /shared/topics --once ...
    spark-submit retailtide/app.py answer total --date 2019-08-18 --tables /shared/tables

With ``--folder`` a topic is a sub-folder of JSON lines instead of a Kafka topic.
Checkpoints go below ``spark.checkpoint.dir`` unless ``--checkpoints`` names a folder,
tables below ``--tables``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from retailtide import streaming  # noqa: E402
from retailtide.operators import dashboard, report  # noqa: E402
from retailtide.operators.visits import with_log_time  # noqa: E402
from retailtide.schemas import BROKEN_TOPIC, TOPICS  # noqa: E402
from retailtide.session import build_session, stored, use_utc  # noqa: E402
from retailtide.sinks import archive_by_day, routed_files, routed_topics  # noqa: E402
from retailtide.sources import file_stream, kafka_topic, parse_records, quarantined  # noqa: E402

RAW_LOGS, RAW_CHANGES = "raw_log", "raw_change"
#: What orders the records of a topic.
VERSION = ("arrived", "offset")
TEXT = T.StructType([T.StructField("value", T.StringType())])


class Shop:
    """The jobs and tables of one deployment."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args = use_utc(spark), args
        tables = args.tables.rstrip("/")
        self.visits = streaming.visit_table(f"{tables}/visits")
        self.devices = streaming.device_table(f"{tables}/devices")
        self.orders = streaming.order_table(f"{tables}/orders")
        self.users = streaming.user_table(f"{tables}/users")
        self.sales = streaming.sale_table(f"{tables}/sales")
        self.alerts = streaming.alert_table(f"{tables}/alerts")

    def checkpoint(self, job: str) -> str:
        shared = self.args.checkpoints or self.spark.conf.get("spark.checkpoint.dir")
        return f"{shared.rstrip('/')}/{job}"

    def raw(self, topic: str) -> DataFrame:
        """(value, arrived, offset) of a topic; the last two order its records."""
        if self.args.brokers:
            return kafka_topic(
                self.spark,
                self.args.brokers,
                self.args.prefix + topic,
                starting=self.args.starting,
                max_per_trigger=self.args.rate,
            )
        folder = f"{self.args.folder.rstrip('/')}/{topic}"
        lines = file_stream(self.spark, folder, TEXT, "text", self.args.rate)
        # the file's time, then what the records themselves say
        version = F.get_json_object("value", f"$.{self.args.version}").try_cast("bigint")
        arrived = F.col("_metadata.file_modification_time").alias("arrived")
        return lines.select("value", arrived, version.alias("offset"))

    def records(self, topic: str) -> DataFrame:
        return parse_records(self.raw(topic), TOPICS[topic], keep=VERSION)

    def routed(self, rows: DataFrame, job: str):
        if self.args.brokers:
            names = {topic: self.args.prefix + topic for topic in (*TOPICS, BROKEN_TOPIC)}
            return routed_topics(rows, self.args.brokers, self.checkpoint(job), names)
        return routed_files(rows, self.args.out, self.checkpoint(job))

    # ---- jobs ----

    def job_archive(self):
        lines = self.raw(RAW_LOGS)
        stamped = streaming.log_archive_stream(lines, F.unix_millis("arrived"))
        return archive_by_day(stamped, self.args.out, self.checkpoint("archive"))

    def job_logs(self):
        lines = self.raw(RAW_LOGS)
        return self.routed(streaming.log_route_stream(lines, F.unix_millis("arrived")), "logs")

    def job_changes(self):
        return self.routed(streaming.change_stream(self.raw(RAW_CHANGES)), "changes")

    def job_visits(self):
        logs = with_log_time(self.records("startup"))
        checkpoint = self.checkpoint("visits")
        return streaming.visit_stream(logs, self.visits, checkpoint, VERSION, self.devices)

    def job_orders(self):
        orders = self.records("order")
        checkpoint = self.checkpoint("orders")
        return streaming.order_stream(orders, self.orders, checkpoint, VERSION)

    def job_users(self):
        feed = self.records("user_info")
        return streaming.user_stream(feed, self.users, self.checkpoint("users"), VERSION)

    def job_sales(self):
        return streaming.sale_stream(
            self.records("order").withColumnRenamed("arrived", "order_ts"),
            self.records("order_detail").withColumnRenamed("arrived", "detail_ts"),
            streaming.users_in(self.users),
            self.sales,
            self.checkpoint("sales"),
        )

    def job_alerts(self):
        events = self.records("event").withColumn("event_ts", F.timestamp_millis("ts"))
        return streaming.alert_stream(events, self.alerts, self.checkpoint("alerts"))

    def job_quarantine(self):
        """Texts that no other job can use, by topic.

        Raw texts come from ``BROKEN_TOPIC``, where the ``logs`` and ``changes`` jobs send them.
        """
        record = F.from_json("value", "source string, reason string, value string")
        letters = self.raw(BROKEN_TOPIC).select(record.alias("r")).select(F.col("r.source").alias("topic"), "r.reason", "r.value")
        found = letters
        for topic, schema in TOPICS.items():
            bad = quarantined(self.raw(topic), schema).select(F.lit(topic).alias("topic"), "reason", "value")
            found = found.union(bad)
        writer = found.writeStream.format("json").partitionBy("topic", "reason")
        return writer.option("path", self.args.out).option("checkpointLocation", self.checkpoint("quarantine"))

    # ---- answers ----

    def _days(self, *days: str) -> tuple[DataFrame, DataFrame]:
        """Visits and orders of some days; the folders of others are not listed."""
        visits = self.visits.read(self.spark, where=F.col("log_date").cast("string").isin(*days))
        return visits, self.orders.read(self.spark, where=F.col("create_date").isin(*days))

    def answer_total(self) -> DataFrame:
        day = self.args.date
        return dashboard.day_totals(*self._days(day), day, self.devices.new_on(self.spark, day))

    def answer_hours(self) -> DataFrame | None:
        day = dt.date.fromisoformat(self.args.date)
        visits, orders = self._days(str(day), str(day - dt.timedelta(days=1)))
        compared = dashboard.compare_hours(self.args.metric, visits, orders, self.args.date)
        return None if compared is None else dashboard.hour_maps(compared)

    def answer_sales(self) -> DataFrame:
        lines = self.sales.read(self.spark, where=F.col("dt") == self.args.date)
        hits = stored(report.search(lines, self.args.date, self.args.keyword), "hits")
        return report.report(hits, self.args.page, self.args.size)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="start a stream job")
    run.add_argument(
        "what",
        choices=["archive", "logs", "changes", "visits", "orders", "users", "sales", "alerts", "quarantine"],
    )
    run.add_argument("--tables", required=True, help="folder of the stored tables")
    source = run.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers", help="Kafka brokers")
    source.add_argument("--folder", help="folder with a sub-folder of JSON lines per topic")
    run.add_argument("--starting", default="latest", help="where a new job begins in a topic")
    run.add_argument("--rate", type=int, default=100_000, help="records (or files) of a micro-batch, at most")
    run.add_argument("--version", default="version", help="number in a record that orders those of a file")
    run.add_argument("--prefix", default="", help="put before every Kafka topic name")
    run.add_argument("--out", help="folder of the archive or of routed files")
    run.add_argument("--checkpoints", help="folder of the checkpoints")
    run.add_argument("--once", action="store_true", help="stop when the source is drained")

    answer = commands.add_parser("answer", help="print a dashboard answer as JSON")
    answer.add_argument("what", choices=["total", "hours", "sales"])
    answer.add_argument("--tables", required=True, help="folder of the stored tables")
    answer.add_argument("--date", required=True)
    answer.add_argument("--metric", default="dau", help="dau or order_amount")
    answer.add_argument("--keyword", default="")
    answer.add_argument("--page", type=int, default=1)
    answer.add_argument("--size", type=int, default=20)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Run a command; returns the printed lines."""
    args = parser().parse_args(argv)
    shop = Shop(spark or build_session(f"retailtide-{args.what}"), args)
    if args.command == "run":
        writer = getattr(shop, f"job_{args.what}")()
        if args.once:
            streaming.drain(writer)
        else:
            streaming.every(writer).awaitTermination()
        return []
    rows = getattr(shop, f"answer_{args.what}")()
    # an answer has a row per metric or one in all
    lines = [] if rows is None else [row[0] for row in report.as_json(rows).collect()]
    print("\n".join(lines))
    return lines


if __name__ == "__main__":
    main()
