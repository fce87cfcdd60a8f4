"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Sizes of a particular cluster (executors,
# memory, shuffle partitions) belong to spark-submit, not here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``master`` is for tests and benches only."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Days and hours are UTC days and hours, whoever made the session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, the session's warehouse, shared by definition, holds it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a work folder that no plan reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def rename_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Moves a work folder, if it is there, in one step; a parent of ``to`` that is missing is made."""
    path, target = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (folder, to))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.mkdirs(target.getParent())
        if not fs.rename(path, target):
            raise OSError(f"{folder} was not moved to {to}")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to a work folder and read back.

    For a result used more than once: without it each use runs the whole plan
    again, and a lost executor costs no more than its own tasks.
    """
    spark = frame.sparkSession
    folder = work_folder(spark, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
