"""Centroid clustering: whole-number k-means whose nearest centroids come from a vantage-point tree.

Each round the centroids are laid into a tree: a node holds one of them, its vantage point,
and shares the others out by their distance to it, the nearer half inside, the rest outside,
with the least and greatest distance of each half. The tree, whose size is that of the
centroids alone, goes out with the round's tasks. Every vector looks at its open nodes in the
order of their bounds (best first), all vectors of a block step by step together, and leaves
a node alone only if its bound is beyond the best distance so far; one that equals it is
looked at, for it may hold a centroid as near with a smaller number. Distances that
decide are whole numbers; only bounds are rounded, and rounded down.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .batches import map_batches

SCALE = 256
#: Centroids that a node holds without parting them.
LEAF = 4
#: Vectors that search together.
BLOCK = 2048
#: A component after scaling, at most: squared distances of 64 such components fit a long.
LARGEST = 1 << 27


@dataclass
class Node:
    """``members`` are looked at when the node is opened; ``low`` and ``high`` bound its centroids' distances to the parent's vantage point."""

    members: np.ndarray
    children: list[int]
    low: float
    high: float


class VantageTree:
    """A vantage-point tree over whole-number ``centroids``; node 0 is its root."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.nodes: list[Node] = []
        self._grow(np.arange(len(centroids)), leaf, 0.0, np.inf)

    def _grow(self, numbers: np.ndarray, leaf: int, low: float, high: float) -> int:
        place = len(self.nodes)
        self.nodes.append(Node(numbers, [], low, high))
        if len(numbers) > leaf:
            # the one farthest from the smallest number sees the others from outside
            vantage = numbers[squares(self.centroids[numbers], self.centroids[numbers[:1]])[:, 0].argmax()]
            rest = numbers[numbers != vantage]
            away = squares(self.centroids[rest], self.centroids[[vantage]])[:, 0]
            order = np.argsort(away, kind="stable")
            self.nodes[place].members = np.array([vantage])
            half = len(order) // 2
            for part in (order[:half], order[half:]):
                if len(part):
                    reach = np.sqrt(away[part].astype(np.float64))
                    child = self._grow(np.sort(rest[part]), leaf, reach.min(), reach.max())
                    self.nodes[place].children.append(child)
        return place

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each vector's nearest centroid, the smaller number of equals; and how many distances that took."""
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        number = np.full(len(vectors), len(self.centroids), dtype=np.int64)
        bounds = np.full((len(vectors), len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(len(vectors))
        looked = 0
        while True:
            first = bounds[active].argmin(axis=1)
            # the radius is inclusive: a bound that equals the best distance may hide a tie
            open_ = bounds[active, first] <= np.sqrt(best[active].astype(np.float64))
            active, first = active[open_], first[open_]
            if not len(active):
                break
            bounds[active, first] = np.inf  # opened
            order = np.argsort(first, kind="stable")
            edges = np.flatnonzero(np.diff(first[order], prepend=-1))
            for begin, end in zip(edges, [*edges[1:], len(order)], strict=True):
                node = self.nodes[first[order[begin]]]
                asking = active[order[begin:end]]
                away = squares(vectors[asking], self.centroids[node.members])
                looked += away.size
                # members stand in the order of their numbers, so the first least one is the smallest number
                pick = away.argmin(axis=1)
                near, found = away[np.arange(len(asking)), pick], node.members[pick]
                better = (near < best[asking]) | ((near == best[asking]) & (found < number[asking]))
                best[asking[better]], number[asking[better]] = near[better], found[better]
                if node.children:
                    reach = np.sqrt(away[:, 0].astype(np.float64))
                    for child in node.children:
                        low, high = self.nodes[child].low, self.nodes[child].high
                        room = 1e-12 * (reach + high) + 1e-9  # more than all rounding
                        bounds[asking, child] = np.maximum(np.maximum(low - reach, reach - high) - room, 0.0)
        return number, best, looked


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``a`` to every row of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for column, row in enumerate(b):
        gap = a - row
        out[:, column] = np.einsum("ij,ij->i", gap, gap)
    return out


def usable(vector: Column, width: int) -> Column:
    """Whether a vector has exactly ``width`` components, all there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == width) & finite, F.lit(False))


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; one beyond ``LARGEST`` fails the job, for its distances may not fit a long."""

    def component(x: Column) -> Column:
        found = F.floor(F.lit(float(scale)) * x.cast("double"))
        message = F.lit(f"a vector component is beyond {LARGEST // scale}")
        return F.when(F.abs(found) <= LARGEST, found.cast("int")).otherwise(F.raise_error(message).cast("int"))

    return F.transform(vector, component)


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    tree = VantageTree(centroids)  # as large as the centroids
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                number, away, _ = tree.nearest(_rows(part.column("ints"), width))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(number, pa.int32()), pa.array(away)], names=["id", "cluster", "distance"])

    return map_batches(vectors, run, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance bigint")


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; empty ones stay.

    Tasks add up their own vectors; at most a row per centroid and place leaves a task.
    """
    tree = VantageTree(centroids)
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros((len(centroids), width), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = _rows(batch.column("ints").slice(start, BLOCK), width)
                number, _, _ = tree.nearest(rows)
                counts += np.bincount(number, minlength=len(centroids))
                order = np.argsort(number, kind="stable")
                own, first = np.unique(number[order], return_index=True)
                sums[own] += np.add.reduceat(rows[order], first, axis=0)
        own = np.flatnonzero(counts)
        place = np.tile(np.arange(width), len(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, width)), pa.array(place), pa.array(sums[own].ravel()), pa.array(np.repeat(counts[own], width))],
            names=["cluster", "place", "total", "count"],
        )

    partial = map_batches(vectors.select("ints"), run, "cluster bigint, place bigint, total bigint, count bigint")
    # a row per centroid and place, however many vectors there are
    total = partial.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("count").alias("count")).toArrow()
    moved = centroids.copy()
    cluster, place, sums, counts = (total.column(name).to_numpy() for name in ("cluster", "place", "total", "count"))
    moved[cluster, place] = sums // counts
    return moved


def kept_vectors(frame: DataFrame, width: int = 64, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, ints): the usable vectors as whole numbers."""
    vector = F.col(vector_col)
    return frame.filter(usable(vector, width)).select(F.col(id_col).alias("id"), whole(vector, scale).alias("ints"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest SHA-256; equal hashes go by components, null ids come last."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    picked = vectors.select(key.alias("key"), "ints").orderBy(F.asc_nulls_last("key"), "ints").limit(k).collect()
    return np.array([row["ints"] for row in picked], dtype=np.int64)


def clustered(
    frame: DataFrame,
    k: int = 40,
    rounds: int = 5,
    width: int = 64,
    scale: int = SCALE,
    salt: str = "2",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of each vector, stored, and the final centroids.

    Kept are vectors of exactly ``width`` components, none null or not finite; a component x
    counts as floor(``scale`` * x). Fewer than ``k`` kept vectors make as many centroids.
    Equal vectors are equal centroids, of which the smallest number gets all vectors and the
    others stay empty and where they are. Repeated ids are vectors of their own; a null id is
    kept. Of an empty table nothing comes, and no centroids. Other columns are not read.
    """
    vectors = stored(kept_vectors(frame, width, scale, id_col, vector_col), "whole-vectors")
    centroids = first_centroids(vectors, k, salt)
    if not len(centroids):
        empty = vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
        return empty.withColumnRenamed("id", id_col), centroids.reshape(0, width)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    return stored(_assigned(vectors, centroids), "clusters").withColumnRenamed("id", id_col), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid``: distances summed by cluster and over all, and the centroid.

    The sums have a row per centroid; they and the centroids are sent back to all tasks.
    """
    sums = {row["cluster"]: row["total"] for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    facts = [(number, total, sum(sums.values()), centroids[number].tolist()) for number, total in sorted(sums.items())]
    schema = "of int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    told = assigned.sparkSession.createDataFrame(facts, schema)
    return assigned.join(F.broadcast(told), F.col("cluster") == F.col("of")).drop("of")
