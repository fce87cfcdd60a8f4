"""JSON text to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import once
from ..schemas import CHANGE

BROKEN = "_broken"
_NUMBERS = (T.LongType, T.IntegerType, T.DoubleType)


def _parsed(raw: DataFrame, schema: T.StructType, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and the fields, with ``BROKEN`` true where the text is no JSON object."""
    # Numbers are read as text first: "7" and 7 are the same to the senders.
    fields = [
        T.StructField(f.name, T.StringType()) if isinstance(f.dataType, _NUMBERS) else f
        for f in schema.fields
    ]
    as_read = T.StructType([*fields, T.StructField(BROKEN, T.StringType())])
    record = F.from_json("value", as_read, {"columnNameOfCorruptRecord": BROKEN})
    opened = raw.select(*keep, once(record).alias("record"))
    typed = [
        F.col(f"record.{f.name}").try_cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, _NUMBERS)
        else F.col(f"record.{f.name}")
        for f in schema.fields
    ]
    # no record at all comes from a missing or an empty text
    broken = F.col("record").isNull() | F.col(f"record.{BROKEN}").isNotNull()
    return opened.select(*keep, broken.alias(BROKEN), *typed)


def parse_records(raw: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of a topic: missing keys stay null, unknown keys are dropped.

    ``raw`` has the text in ``value``; ``keep`` names columns of ``raw`` (an
    offset, an arrival time) to carry along. Text that is no JSON object is left
    out here and can be had from :func:`rejected_records`.
    """
    return _parsed(raw, schema, keep).filter(~F.col(BROKEN)).drop(BROKEN)


def rejected_records(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that :func:`parse_records` leaves out, for a quarantine folder."""
    names = tuple(raw.columns)
    return _parsed(raw, schema, names).filter(F.col(BROKEN)).select(*names)


def quarantined(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """(value, reason): the texts that the jobs of a topic cannot use.

    ``broken`` is no JSON object, ``no time`` a record without ``ts`` where the topic has one.
    """
    opened = _parsed(raw, schema, ("value",))
    reason = F.when(F.col(BROKEN), "broken")
    if "ts" in schema.names:
        reason = reason.when(F.col("ts").isNull(), "no time")
    return opened.select("value", reason.alias("reason")).filter("reason IS NOT NULL")


def open_changes(raw: DataFrame) -> tuple[DataFrame, Column]:
    """All change records with their raw ``text``, and why one cannot be used (null if it can).

    ``broken`` is no JSON object, ``no type`` an object that does not say what it is.
    """
    opened = _parsed(raw.withColumn("text", F.col("value")), CHANGE, ("text",))
    reason = F.when(F.col(BROKEN), "broken").when(F.col("entry_type").isNull(), "no type")
    return opened, reason


def parse_changes(raw: DataFrame) -> DataFrame:
    """Change records of the shop database from their JSON text."""
    return parse_records(raw, CHANGE)
