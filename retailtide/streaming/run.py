"""Starting jobs: on a clock, or once over what is there."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

TRIGGER = "5 seconds"


def every(writer: DataStreamWriter, interval: str = TRIGGER) -> StreamingQuery:
    """Start a job that takes a micro-batch per interval."""
    return writer.trigger(processingTime=interval).start()


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now, then stop. The query's progress tells how it went."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# A run that starts anew loads the state. From a log of changes it would take in again all that
# earlier runs added and dropped, so that each costs more than the one before; a snapshot
# holds what is left.
ONE_RUN_EACH = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}


# Nothing goes back in a replay: of earlier batches neither states in memory nor files of changes are needed.
# The stores of one executor share one bound of memory beyond the heap; without it each partition's four have their own.
LAST_STATE = {
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def _set(settings: dict[str, str]) -> Iterator[None]:
    """The session's settings changed for a while."""
    conf = SparkSession.builder.getOrCreate().conf
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def follow(writer: DataStreamWriter, arrivals: Iterable, partitions: int) -> StreamingQuery | None:
    """One run that processes each arrival before it asks for the next, then stops.

    An arrival must come in at once. State stays where it is from one to the next; runs of their own would load it anew.
    Arrivals of bounded size need no more than some ``partitions``, each of which writes files of state in every batch.
    """
    conf, query = SparkSession.builder.getOrCreate().conf, None
    fewer = min(partitions, int(conf.get("spark.sql.shuffle.partitions")))
    try:
        for _ in arrivals:
            if query is None:
                with _set({**LAST_STATE, "spark.sql.shuffle.partitions": str(fewer)}):
                    query = every(writer, "0 seconds")
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return query


def drain_each(writer: DataStreamWriter, arrivals: Iterable) -> list[StreamingQuery]:
    """Process what each arrival brings in a run of its own; the checkpoint hands state on from run to run.

    State goes into the checkpoint as a snapshot, whatever the session does for jobs that go on.
    """
    runs = []
    for _ in arrivals:
        with _set(ONE_RUN_EACH):
            runs.append(drain(writer))
    return runs
