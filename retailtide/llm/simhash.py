"""SimHash near copies: fingerprints, links by deletion variants, connected components.

The fingerprints are cut into so few segments that two of them within the
allowed distance differ by at most one bit in some segment. Each is indexed under
that segment with each single bit left out, so linked ones meet in an equality
join, which verifies the whole distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_folder, stored, work_folder
from .batches import map_batches, text_slices, unused

BITS = 64
#: A key under which more fingerprints lie is divided by further bits before any
#: two are compared. Results are the same for every value of at least 64.
CROWD = 1024
#: Classes of equal fingerprints with more than one in so many of all rows meet their label
#: in a broadcast; there are fewer of them.
HOT_CLASSES = 1 << 12

_HASH = partial(xxhash.xxh64_intdigest, seed=42)


def _fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit fingerprint of one text."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        hashes = np.array([_HASH(b" ".join(parts))], dtype=np.uint64)
    else:
        runs = zip(*(parts[i:] for i in range(words)), strict=False)
        hashes = np.fromiter(map(_HASH, map(b" ".join, runs)), np.uint64, len(parts) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    # blocks of 255 rows add up within one byte
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    full = len(bits) // 255 * 255
    if full:
        ones += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    ones += bits[full:].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint) of each row; the fingerprint is a signed 64-bit number.

    A-Z count as a-z, words are runs without ASCII white space, and a bit is 1 if
    it is set in over half of the hashes of all word runs, repeats included. A
    text of fewer words is one run; a null or empty text has fingerprint 0.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = [_fingerprint(text, words) for text in part.column("text").to_pylist()]
                yield pa.record_batch([part.column("id"), pa.array(found, pa.int64())], names=["id", "fingerprint"])

    id_type = picked.schema["id"].dataType.simpleString()
    return map_batches(picked, run, f"id {id_type}, fingerprint bigint").withColumnRenamed("id", id_col)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _cut(free: int, parts: int) -> list[tuple[int, int]]:
    """(bits kept, bit left out or 0) for each key over the free bits.

    The lowest bit of a segment is named 0: its key also stands for pairs that
    agree on the whole segment, so that these meet under one key only.
    """
    places = [b for b in range(BITS) if free >> b & 1]
    keys = []
    for part in range(parts):
        segment = places[len(places) * part // parts : len(places) * (part + 1) // parts]
        whole = sum(1 << b for b in segment)
        for bit in segment:
            keys.append((whole & ~(1 << bit), 0 if bit == segment[0] else 1 << bit))
    return keys


def links(prints: DataFrame, max_bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most ``max_bits`` bits.

    ``prints`` has one distinct ``fingerprint`` a row and is read several times, so
    it should be a stored table. Keys that hold more than ``crowd`` fingerprints are
    divided: the bits not yet in the key are cut in the same way, until a key leaves
    too few bits for a crowd. So no pair is lost and no large group is ever compared.
    """
    spark = prints.sparkSession
    parts = max_bits // 2 + 1
    everything = (1 << BITS) - 1
    keys = _cut(everything, parts)
    items = ", ".join(f"named_struct('kept', {_signed(kept)}L, 'wild', {_signed(wild)}L)" for kept, wild in keys)
    keyed = prints.select("fingerprint", F.explode(F.expr(f"array({items})")).alias("m"))
    found = None
    while True:
        keyed = keyed.select("fingerprint", "m.kept", "m.wild", (F.col("fingerprint").bitwiseAND(F.col("m.kept"))).alias("value"))
        shared = stored(keyed.groupBy("kept", "value").count().filter("count > 1"), "simhash-keys")
        # a shuffle at every size: the keys grow with the table
        few = shared.filter(F.col("count") <= crowd).select("kept", "value")
        meeting = keyed.join(few.hint("merge"), ["kept", "value"])
        meeting = stored(meeting, "simhash-meeting")
        left, right = meeting.alias("l"), meeting.alias("r")
        differ = F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint"))
        same_key = (F.col("l.kept") == F.col("r.kept")) & (F.col("l.value") == F.col("r.value")) & (F.col("l.wild") == F.col("r.wild"))
        once = (F.col("l.wild") == 0) | (differ.bitwiseAND(F.col("l.wild")) != 0)
        near = (F.col("l.fingerprint") < F.col("r.fingerprint")) & (F.bit_count(differ) <= max_bits)
        pairs = left.join(right, same_key & once & near).select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"))
        found = pairs if found is None else found.union(pairs)
        hot = shared.filter(F.col("count") > crowd).select("kept", "value")
        masks = [row["kept"] for row in hot.select("kept").distinct().collect()]  # of a fixed, small set
        if not masks:
            return found.distinct()
        # the next level: each crowded key continued by the keys over its free bits
        children = [(kept, kept | _signed(more), 0) for kept in masks for more, _ in _cut(everything & ~kept, parts)]
        table = spark.createDataFrame(children, "kept bigint, next bigint, wild bigint")
        crowded = keyed.select("fingerprint", "kept", "value").join(hot, ["kept", "value"]).select("fingerprint", "kept")
        keyed = crowded.join(table, "kept").select("fingerprint", F.struct(F.col("next").alias("kept"), "wild").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root): the connected components of ``edges`` (a, b bigint), for all vertices with an edge.

    In each round every vertex joins the neighbour (or itself) that comes first in
    an order drawn anew by hash, and edges inside one class go. A fixed share of
    the vertices is expected to go in each round, whatever the shape. The root is any
    vertex of the class.
    """
    spark = edges.sparkSession
    folder = work_folder(spark, "components")
    edges.select("a", "b").filter("a <> b").write.parquet(f"{folder}/edges-0")
    rounds = 0
    while True:
        now = spark.read.schema("a bigint, b bigint").parquet(f"{folder}/edges-{rounds}")
        if not now.take(1):
            break
        both = now.union(now.select("b", "a"))
        first = F.min(F.struct(F.xxhash64(F.lit(rounds), "b").alias("h"), F.col("b").alias("v")))
        mine = F.struct(F.xxhash64(F.lit(rounds), "a").alias("h"), F.col("a").alias("v"))
        into = both.groupBy("a").agg(first.alias("best")).select("a", F.least("best", mine)["v"].alias("into"))
        into.write.parquet(f"{folder}/map-{rounds}")
        step = spark.read.schema("a bigint, into bigint").parquet(f"{folder}/map-{rounds}")
        moved = now.join(step, "a").select(F.col("into").alias("x"), "b")
        moved = moved.join(step.withColumnRenamed("a", "b"), "b").select("x", F.col("into").alias("y"))
        moved = moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        moved.write.parquet(f"{folder}/edges-{rounds + 1}")
        drop_folder(spark, f"{folder}/edges-{rounds}")
        rounds += 1
    if not rounds:
        return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    # where each vertex of round k ended: read from the last round back. Each step is a table of
    # its own, so that no plan, and no set of broadcasts at one time, grows with the rounds
    ends = None
    for number in reversed(range(rounds)):
        step = spark.read.schema("a bigint, into bigint").parquet(f"{folder}/map-{number}")
        if ends is None:
            ends = step.select(F.col("a").alias("vertex"), F.col("into").alias("root"))
        else:
            later = ends.withColumnRenamed("vertex", "into")
            joined = step.join(later, "into", "left")
            joined = joined.select(F.col("a").alias("vertex"), F.coalesce("root", "into").alias("root"))
            joined.write.parquet(f"{folder}/ends-{number}")
            drop_folder(spark, f"{folder}/ends-{number + 1}")
            ends = spark.read.schema("vertex bigint, root bigint").parquet(f"{folder}/ends-{number}")
    return ends


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3) -> DataFrame:
    """(id, fingerprint, component_id, links) of each row of ``docs``.

    ``component_id`` is the smallest id that links reach, the row's own included;
    null ids come after all others. ``n_links`` counts the other distinct fingerprints
    within ``max_bits``. Repeated rows, ties and extra columns change nothing: only
    the two named columns are read, and one row comes out per row. An empty table
    gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    classes = prints.groupBy("fingerprint").agg(F.min(id_col).alias("smallest"), F.count(F.lit(1)).alias("n_rows"))
    classes = stored(classes, "simhash-classes")
    rows = classes.agg(F.sum("n_rows").alias("n")).first()["n"] or 0
    pairs = stored(links(classes.select("fingerprint"), max_bits), "simhash-links")
    both = pairs.select("a").union(pairs.select("b"))
    degree = both.groupBy(F.col("a").alias("fingerprint")).agg(F.count(F.lit(1)).alias("n_links"))
    roots = components(pairs).withColumnRenamed("vertex", "fingerprint")
    linked = classes.join(roots, "fingerprint").select("fingerprint", "root", "smallest")
    least = linked.groupBy("root").agg(F.min("smallest").alias("component_id"))
    members = roots.join(least, "root").join(degree, "fingerprint").select("fingerprint", "component_id", "n_links")
    labels = classes.join(members, "fingerprint", "left").select(
        "fingerprint",
        (F.col("n_rows") > rows / HOT_CLASSES).alias("hot"),
        F.coalesce("component_id", "smallest").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
    labels = stored(labels, "simhash-labels")
    # classes that would weigh in a partition meet their label in a broadcast of a fixed bound
    hot, rest = (labels.filter(part).drop("hot") for part in (F.col("hot"), ~F.col("hot")))
    hot = F.broadcast(hot)
    found = (prints.join(hot, "fingerprint"), prints.join(hot, "fingerprint", "left_anti").join(rest, "fingerprint"))
    both = [part.select(id_col, "fingerprint", "component_id", "n_links") for part in found]
    return both[0].union(both[1])


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id.

    A null id comes after all others; of rows with one id, that of the smallest text hash
    stays, and of equal rows one. Columns may have any names and stay as they are; null and empty
    texts are one group. An empty table stays empty.
    """
    row, gone_row = unused(docs, "row"), unused(docs, "gone")
    text_hash = F.xxhash64(F.coalesce(text_col, F.lit("")))
    named = docs.withColumn(row, F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text_hash.alias("text_hash")))
    found = near_copies(named.select(row, text_col), row, text_col, words, max_bits)
    gone = found.filter(F.col(row) != F.col("component_id")).select(F.col(row).alias(gone_row)).distinct()
    # by the whole key, so that neither side can pile up on null ids
    kept = named.join(gone, F.col(row) == F.col(gone_row), "left_anti")
    return kept.dropDuplicates([row]).select(*docs.columns)
