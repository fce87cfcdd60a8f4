"""Records sent to the topic that their ``topic`` column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


def routed_topics(
    routed: DataFrame, brokers: str, checkpoint: str, names: dict[str, str] | None = None
) -> DataStreamWriter:
    """Kafka writer of (topic, value); ``names`` maps logical to physical topics."""
    topic = F.col("topic")
    if names:
        topic = F.coalesce(*[F.when(topic == k, F.lit(v)) for k, v in names.items()], topic)
    return (
        routed.select(topic.alias("topic"), "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("checkpointLocation", checkpoint)
    )


def routed_files(routed: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The same as text files, one folder per topic."""
    return (
        routed.select("topic", "value")
        .writeStream.format("text")
        .partitionBy("topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
