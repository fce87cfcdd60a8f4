"""Keyword search by an inverted index: which lines of a day have a word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import tokens
from ..session import work_folder

#: Folders that the words of a day are dealt out to by hash.
BUCKETS = 16


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def postings(lines: DataFrame) -> DataFrame:
    """(dt, bucket, term, order_detail_id): a row per line and different word of its product name."""
    terms = F.explode(F.array_distinct(tokens(F.col("sku_name"))))
    found = lines.select("dt", terms.alias("term"), "order_detail_id")
    return found.withColumn("bucket", _bucket(F.col("term")))


def stored_index(lines: DataFrame) -> DataFrame:
    """:func:`postings` written out in the order of day and word, so that a word is few row groups."""
    spark = lines.sparkSession
    folder = work_folder(spark, "postings")
    found = postings(lines)
    # ranges of (day, bucket, word, line): a word that all lines have is many ranges
    ranged = found.repartitionByRange("dt", "bucket", "term", "order_detail_id").sortWithinPartitions("dt", "bucket", "term")
    ranged.write.parquet(folder)
    return spark.read.schema(found.schema).parquet(folder)


def terms_of(spark: SparkSession, keyword: str | None) -> list[str]:
    """The different words of a keyword."""
    row = spark.range(1).select(F.array_distinct(tokens(F.lit(keyword or ""))).alias("terms")).first()
    return sorted(row["terms"])


def indexed(lines: DataFrame, index: DataFrame, day: str, keyword: str | None) -> DataFrame:
    """Lines of a day whose product name has every word of ``keyword``, which may have any number of words.

    The postings of the words meet by line; a line that has all of them is counted as often as
    there are words. A keyword without words finds nothing.
    """
    terms = terms_of(lines.sparkSession, keyword)
    own = index.filter(F.col("dt") == day).filter(F.col("term").isin(terms))
    found = own.groupBy("order_detail_id").agg(F.count("*").alias("words")).filter(F.col("words") == len(terms))
    if not terms:
        found = found.limit(0)
    return lines.filter(F.col("dt") == day).join(found.select("order_detail_id"), "order_detail_id", "left_semi")
