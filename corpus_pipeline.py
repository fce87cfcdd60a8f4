"""The training-text pipeline: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm import decontam, lines, packing, quality, simhash
from retailtide.llm.batches import unused
from retailtide.session import work_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is judged as an empty one; repeated rows are judged alike. All columns stay,
    whatever their names, and an empty table stays empty.
    """
    model = quality.classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "score")
    return quality.scored(docs, model, score_col=score).filter(F.col(score) >= 0.5).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that five or more share; the last of these keeps its own.

    ``n_chars`` follows the text; a document may be left empty, none goes. Null and empty texts
    are one empty line and stay; repeated rows lose the same lines.
    """
    found = lines.with_bitmaps(docs)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, lines.kept_text(F.col("text"), F.col("keep_runs"))).otherwise(F.col("text"))
    cut = found.withColumn("text", text)
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id; see :func:`simhash.one_of_each`."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; see :func:`decontam.clean`."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens; see :func:`packing.pieces`."""
    return packing.packed(docs, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("lines", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", sequences),
]

#: Classifiers, near copies and token packing are beyond SQL; the tests hold the
#: whole run against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
