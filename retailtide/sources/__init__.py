"""Where rows come from: topics, file streams, tables, change records."""

from .records import open_changes, parse_changes, parse_records, quarantined, rejected_records
from .tables import jdbc_table, on_day, parquet_table
from .topics import BoundedReplay, Replay, file_stream, kafka_options, kafka_topic, replay_bounded, replay_in_order

__all__ = [
    "BoundedReplay",
    "Replay",
    "file_stream",
    "jdbc_table",
    "kafka_options",
    "kafka_topic",
    "on_day",
    "parquet_table",
    "open_changes",
    "parse_changes",
    "parse_records",
    "quarantined",
    "rejected_records",
    "replay_bounded",
    "replay_in_order",
]
