"""Exact top-k by inner product: vectors by falling length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

Vectors become whole numbers. They are rotated so that the first places hold most of the
length; after each share of the places, a pair's score is at most its partial sum plus
the product of what is left of both lengths. Pairs whose bound is below the query's k-th
score so far are out; the score of all others is computed in whole numbers. Files hold
ranges of lengths, each from the longest down. A task may read several of them in any
order, so each block of vectors is judged by its own length and passed over when no
query can gain from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored, work_folder
from .batches import map_batches

SCALE = 1024
#: Queries that one pass over the vectors answers, and vectors looked at together.
QUERY_BLOCK, VECTOR_BLOCK = 2048, 2048
#: The longest vectors, which give each query its first bound.
HEAD = 2048


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors are filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sums of products of components over all vectors, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column("ints"), width).astype(np.float64)
            total += rows.T @ rows
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, total)], names=["i", "j", "v"])

    sums = map_batches(vectors.select("ints"), run, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    out[sums.column("i").to_numpy(), sums.column("j").to_numpy()] = sums.column("v").to_numpy()
    return out


class Rotated:
    """Whole-number rows with their rotated places and what is left of their length after each cut."""

    def __init__(self, ids: np.ndarray, ints: np.ndarray, rotation: np.ndarray):
        self.ids, self.ints = ids, ints
        self.turned = ints.astype(np.float64) @ rotation
        width = ints.shape[1]
        self.cuts = sorted({max(1, width * part // 4) for part in (1, 2, 3, 4)})
        squares = np.cumsum(self.turned**2, axis=1)
        self.length = np.sqrt((ints.astype(np.float64) ** 2).sum(axis=1))
        self.left = [np.sqrt(np.maximum(self.length**2 - squares[:, cut - 1], 0)) for cut in self.cuts]


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1)


@dataclass
class Best:
    """The best rows of each query so far, and the score that a new one has to reach."""

    k: int
    bound: np.ndarray
    query: np.ndarray
    score: np.ndarray
    vec: np.ndarray

    @classmethod
    def none(cls, k: int, queries: int) -> Best:
        return cls(k, np.full(queries, -np.inf), *(np.zeros(0, dtype=np.int64) for _ in range(3)))

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        query, score, vec = (np.concatenate(pair) for pair in ((self.query, query), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        first = np.searchsorted(query, query, "left")
        rank = np.arange(len(query)) - first
        kept = rank < self.k
        last = rank == self.k - 1
        self.bound[query[last]] = np.maximum(self.bound[query[last]], score[last])
        self.query, self.score, self.vec = query[kept], score[kept], vec[kept]


def search(queries: Rotated, rows: Rotated, best: Best) -> bool:
    """Adds what ``rows`` offer; False if all are too short for every query."""
    # rounding of sums of this size, and a bit of room
    room = 1e-9 * queries.length[:, None] * max(rows.length.max(initial=0), 1) + 1e-6
    reach = queries.length * rows.length.max(initial=0) + room[:, 0] >= best.bound
    if not reach.any():
        return False
    active = np.flatnonzero(reach)
    bound = best.bound[active, None] - room[active]
    total = np.zeros((len(active), len(rows.ids)))
    begin = 0
    for cut, q_left, r_left in zip(queries.cuts, queries.left, rows.left, strict=True):
        total += queries.turned[active, begin:cut] @ rows.turned[:, begin:cut].T
        alive = total + q_left[active, None] * r_left >= bound
        begin = cut
        if alive.mean() < 0.02:
            break
    alive &= queries.ids[active, None] != rows.ids
    q, r = np.nonzero(alive)
    q = active[q]
    for part in range(0, len(q), 1 << 16):
        some, those = q[part : part + (1 << 16)], r[part : part + (1 << 16)]
        score = _exact(queries.ints[some], rows.ints[those])
        good = score >= best.bound[some]
        best.add(some[good], score[good], rows.ids[those[good]])
    return True


def _dealt(held: DataFrame, blocks: int) -> DataFrame:
    """(id, ints, block) of the queries, dealt by chance so that an id that repeats fills no block, and stored by block."""
    spark = held.sparkSession
    folder = work_folder(spark, "queries")
    drawn = held.filter("asks").select("id", "ints", F.floor(F.rand(11) * blocks).cast("int").alias("block"))
    drawn.repartition("block").write.partitionBy("block").parquet(folder)
    return spark.read.schema("id bigint, ints array<bigint>, block int").parquet(folder)


def top_k(
    frame: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the highest integer inner product for each query row, exactly.

    Components x count as floor(scale * x). Ties go to the smaller id. Rows with the query's
    own id are no answers to it; if an id repeats, each of its rows is a row of its own, and
    each query row is answered. Rows without id, vector or with a component that is null or not
    finite take no part; shorter vectors are filled up with zeros. All rows are returned
    if there are fewer than ``k``; empty tables give none.

    The queries pass in blocks of about ``QUERY_BLOCK``: the answers of one are written to a
    work folder and its broadcast is released before the next is read.
    """
    taking = frame.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    vectors = taking.select(F.col(id_col).cast("long").alias("id"), whole(F.col(vector_col), scale).alias("ints"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    length = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("length2")
    # in falling length, each file a range of it
    ordered = vectors.select("*", length).repartitionByRange(F.desc("length2"), "id").sortWithinPartitions(F.desc("length2"), "id")
    held = stored(ordered, "vectors")
    spark = frame.sparkSession
    facts = held.agg(F.max(F.size("ints")).alias("width"), F.count_if("asks").alias("asks"), F.count(F.lit(1)).alias("rows")).first()
    if not facts["asks"]:
        return spark.createDataFrame([], f"query_id bigint, rank int, `{id_col}` bigint, score bigint")
    width = facts["width"]
    values, vectors_of = np.linalg.eigh(_gram(held, width))
    rotation = vectors_of[:, np.argsort(-values)]
    # any rows give a right bound; long ones give a high one
    share = max(0.0, 1 - HEAD / facts["rows"])
    long = held.agg(F.percentile_approx("length2", F.lit(share)).alias("at")).first()["at"]
    head_rows = held.filter(F.col("length2") >= long).limit(HEAD).select("id", "ints").toArrow().combine_chunks().to_batches()[0]
    head = Rotated(head_rows.column("id").to_numpy(), _matrix(head_rows.column("ints"), width), rotation)
    blocks = -(-facts["asks"] // QUERY_BLOCK)
    asking = _dealt(held, blocks)
    answers = work_folder(spark, "answers")
    for block in range(blocks):
        asked = asking.filter(F.col("block") == block).select("id", "ints").toArrow()
        if not asked.num_rows:
            continue
        asked = asked.combine_chunks().to_batches()[0]
        queries = Rotated(asked.column("id").to_numpy(), _matrix(asked.column("ints"), width), rotation)
        first = Best.none(k, len(queries.ids))
        search(queries, head, first)
        shared = spark.sparkContext.broadcast((queries, first.bound, rotation))  # one block of queries

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries, bound, rotation = shared.value
            best = Best.none(k, len(queries.ids))
            best.bound = bound.copy()
            for batch in batches:
                for start in range(0, batch.num_rows, VECTOR_BLOCK):
                    part = batch.slice(start, VECTOR_BLOCK)
                    rows = Rotated(part.column("id").to_numpy(), _matrix(part.column("ints"), width), rotation)
                    search(queries, rows, best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.query), pa.array(queries.ids[best.query]), pa.array(best.vec), pa.array(best.score)],
                names=["row", "query_id", "id", "score"],
            )

        found = map_batches(held.select("id", "ints"), run, "row bigint, query_id bigint, id bigint, score bigint")
        order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "id", "score").write.mode("append").parquet(answers)
        shared.destroy()
    found = spark.read.schema("query_id bigint, rank int, id bigint, score bigint").parquet(answers)
    return found.withColumnRenamed("id", id_col)
