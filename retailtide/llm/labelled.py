"""A bounded sample of labelled documents, and the split that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def sample(docs: DataFrame, labels: DataFrame, label_col: str, parts: int, held_out: int, most: int) -> DataFrame:
    """(text, label) of about ``most`` documents, half of each label, outside the held-out part.

    ``most`` bounds the expected number; which rows are taken is drawn by a hash of the
    id, so a run again takes the same. Rows of a label with fewer are all taken. Ids with
    several or with null labels are left out.
    """
    known = labels.groupBy("doc_id").agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
    known = known.filter("label = other AND label IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "label")
    known = known.filter(remainder(F.col("doc_id"), parts) != held_out)
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    scale = 1 << 20
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(scale, -(-most // 2 * scale // n)))]) if counts else F.lit(None)
    taken = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(scale)) < F.try_element_at(share, F.col("label"))) if counts else known
    # ``most`` bounds what is broadcast
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("text", F.col("label").cast("int").alias("label"))
