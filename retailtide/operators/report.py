"""The sale search report: hits, buckets, shares, page."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    AGE_BANDS,
    GENDERS,
    STAT_TITLES,
    age_band,
    matches_all,
    one_decimal_percent,
)
from ..session import stored

# How many buckets the report asks for.
GENDER_BUCKETS = 2
AGE_BUCKETS = 100


def search(lines: DataFrame, day: str, keyword: str) -> DataFrame:
    """Lines of a day whose product name has every word of ``keyword``."""
    return lines.filter(F.col("dt") == day).filter(matches_all(F.col("sku_name"), keyword))


def page(hits: DataFrame, number: int, size: int, order: str = "order_detail_id") -> DataFrame:
    """Page ``number`` (from 1) of the hits; a per-task top-k, not a full sort."""
    return hits.orderBy(order).offset((number - 1) * size).limit(size)


def deep_page(hits: DataFrame, number: int, size: int, order: str = "order_detail_id") -> DataFrame:
    """Page ``number`` (from 1) of the hits, however far down; ``order`` must leave no ties.

    The hits are stored in ranges of ``order``, which are counted, a number per range; the sums
    of the counts say which ranges hold the page, and only these are read and sorted. No task
    meets more than a range, where :func:`page` lets offset and page meet in one.
    """
    ranged = hits.repartitionByRange(order).withColumn("_range", F.spark_partition_id())
    held = stored(ranged, "ranges")
    first, last = (number - 1) * size, number * size
    before, within = 0, []
    skipped = 0
    for row in sorted(held.groupBy("_range").count().collect()):
        after = before + row["count"]
        if after <= first:
            skipped = after
        elif before < last:
            within.append(row["_range"])
        before = after
    wanted = held.filter(F.col("_range").isin(within)).drop("_range")
    return wanted.orderBy(order).offset(first - skipped).limit(size)


def hit_total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count("*").alias("total"))


def top_terms(hits: DataFrame, column: str, size: int) -> DataFrame:
    """The ``size`` most frequent values with their counts; null is no value."""
    counts = hits.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("hits")
    )
    return counts.orderBy(F.col("hits").desc(), F.col(column)).limit(size)


def gender_terms(hits: DataFrame) -> DataFrame:
    return top_terms(hits, "user_gender", GENDER_BUCKETS)


def age_terms(hits: DataFrame) -> DataFrame:
    return top_terms(hits, "user_age", AGE_BUCKETS)


def shares(hits: DataFrame) -> DataFrame:
    """One row: total, then the percent of each gender and each age band.

    One pass over the hits, one row per task to combine.
    """
    band = age_band(F.col("user_age"))
    parts = {key: F.col("user_gender") == key for key in GENDERS}
    parts |= {key: band == key for key in AGE_BANDS}
    counts = hits.agg(
        F.count("*").alias("total"), *[F.count_if(test).alias(key) for key, test in parts.items()]
    )
    return counts.select(
        "total", *[one_decimal_percent(F.col(key), F.col("total")).alias(key) for key in parts]
    )


def gender_share(hits: DataFrame) -> DataFrame:
    return shares(hits).select("total", *GENDERS)


def age_band_share(hits: DataFrame) -> DataFrame:
    return shares(hits).select("total", *AGE_BANDS)


def stats(hits: DataFrame) -> DataFrame:
    """One row: total and ``stat``, the titled option lists."""

    def stat(title: str, options: dict[str, str]):
        named = [
            F.struct(F.lit(label).alias("name"), F.col(key).alias("value"))
            for key, label in options.items()
        ]
        return F.struct(F.lit(STAT_TITLES[title]).alias("title"), F.array(*named).alias("options"))

    return shares(hits).select(
        "total", F.array(stat("gender", GENDERS), stat("age", AGE_BANDS)).alias("stat")
    )


def stat_rows(hits: DataFrame) -> DataFrame:
    """:func:`stats` as rows (total, title, name, value)."""
    titled = stats(hits).select("total", F.inline("stat"))
    return titled.select("total", "title", F.inline("options"))


def report(hits: DataFrame, number: int, size: int) -> DataFrame:
    """One row (total, stat, detail): the whole answer, ``detail`` being one page.

    The hits are used twice: once for the numbers, once for the page.
    """
    names = [name for name in hits.columns if name != "order_detail_id"]
    rows = page(hits, number, size).agg(
        F.sort_array(F.collect_list(F.struct("order_detail_id", *names))).alias("detail")
    )
    # two aggregates of one row each, laid over one another
    both = stats(hits).unionByName(rows, allowMissingColumns=True)
    return both.agg(*[F.first(name, ignorenulls=True).alias(name) for name in both.columns])


def as_json(answer: DataFrame) -> DataFrame:
    """Each row as one JSON text, for the edge."""
    return answer.select(F.to_json(F.struct("*")).alias("answer"))
