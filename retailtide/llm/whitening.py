"""Whitened principal components of vectors, by distributed block matrices.

Centred rows get consecutive numbers and become a BlockMatrix, a block per run of rows. Its
transpose times itself, in many parts that are added up, is the scatter, whose size is that
of a vector squared; its eigenvectors are found locally. The rows are projected by a block
product with the whitening matrix. For that product the blocks are laid out as a square and
the whitening matrix along a diagonal, because MLlib cuts a grid of blocks by both sides: a
single column of blocks would meet in the square root of the tasks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

SCALE, SHIFT = 1024, 100_000
#: Bytes of a block of rows, and of the blocks that a task of a product holds, about.
BLOCK_BYTES, TASK_BYTES = 1 << 20, 16 << 20
#: MLlib plans a product on the driver by the numbers of its blocks. Beyond this many, blocks grow.
MOST_BLOCKS = 1 << 18
#: An eigenvalue below this share of the largest is rounding, for each dimension.
ROUNDING = 1e-13


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * x) + shift of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint") + F.lit(shift))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` stored, with ``number``: 0, 1, 2 and so on without a gap.

    Each task counts its own rows as it writes them; then one count per task is summed up.
    No row moves for it.
    """
    place = F.monotonically_increasing_id()
    task = F.shiftright(place, 33)
    held = stored(rows.withColumns({"task": task, "place": place - F.shiftleft(task, 33)}), "numbered")
    counts = sorted(held.groupBy("task").count().collect())
    before = itertools.accumulate((row["count"] for row in counts[:-1]), initial=0)
    bases = [(row["task"], base) for row, base in zip(counts, before, strict=False)]
    told = rows.sparkSession.createDataFrame(bases, "task bigint, base bigint")  # a row per task
    return held.join(F.broadcast(told), "task").withColumn("number", F.col("base") + F.col("place")).drop("task", "place", "base")


def _blocks(matrix: BlockMatrix, row: Callable[[Column, Column], Column], col: Callable[[Column, Column], Column]) -> DataFrame:
    """The blocks of ``matrix`` as MLlib's own table, each moved to a new row and column of the grid."""
    found = callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model).toDF("at", "block")
    at = (F.col("at._1"), F.col("at._2"))
    moved = F.struct(row(*at).cast("bigint").alias("_1"), col(*at).cast("bigint").alias("_2"))
    return found.select(moved.alias("at"), "block")


def _of_blocks(blocks: DataFrame, block: tuple[int, int], size: tuple[int, int]) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, *block, *size), *block)


def block_matrix(rows: DataFrame, width: int, count: int, rows_per_block: int) -> BlockMatrix:
    """The matrix of ``count`` rows (``number``, ``values``), one block wide."""
    named = rows.select(F.col("number").alias("index"), array_to_vector("values").alias("vector"))
    indexed = MLUtils.convertVectorColumnsFromML(named, "vector")
    return IndexedRowMatrix(indexed, count, width).toBlockMatrix(rows_per_block, width)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, which is as large as a row squared.

    Blocks are multiplied and added up in as many tasks as there are ``TASK_BYTES`` of them.
    """
    parts = -(-matrix.numRowBlocks // _task_blocks(matrix))
    other = matrix._java_matrix_wrapper._java_model
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", other, parts)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """(``number``, ``values``): each row of ``matrix``, which is one block wide, times ``whitening``."""
    width, out = whitening.shape
    side = math.ceil(math.sqrt(matrix.numRowBlocks))
    tall = -(-matrix.numRowBlocks // side)
    square = _of_blocks(
        _blocks(matrix, lambda row, _: F.floor(row / side), lambda row, _: row % side), (matrix.rowsPerBlock, width), (tall * matrix.rowsPerBlock, side * width)
    )
    block = DenseMatrix(width, out, whitening.ravel(order="F"))
    # the grid of the product is cut into as many parts as its larger factor has
    parts = max(1, -(-matrix.numRowBlocks // _task_blocks(matrix)))
    context = SparkSession.getActiveSession().sparkContext
    diagonal = BlockMatrix(context.parallelize([((i, i), block) for i in range(side)], parts), width, out, side * width, side * out)
    product = square.multiply(diagonal)
    column = _of_blocks(_blocks(product, lambda row, col: row * side + col, lambda _, __: F.lit(0)), (matrix.rowsPerBlock, out), (matrix.numRows(), out))
    rows = callMLlibFunc("getIndexedRows", column.toIndexedRowMatrix()._java_matrix_wrapper._java_model).toDF("number", "values")
    return rows.select("number", vector_to_array("values").alias("values"))


def _task_blocks(matrix: BlockMatrix) -> int:
    return max(1, TASK_BYTES // (8 * matrix.rowsPerBlock * matrix.colsPerBlock))


def whitened(
    frame: DataFrame,
    components: int = 8,
    scale: int = SCALE,
    shift: int = SHIFT,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, n, deviation, values, explained, identity_error) of each vector, its ``components`` whitened places in ``values``.

    A component c of a vector counts as x = floor(scale * c) + shift. Mean and covariance are
    those of all vectors, divided by their number n; places are unit eigenvectors by falling
    eigenvalue e, and a whitened value is the centred vector's share of it over sqrt(e).
    ``explained`` holds e / trace for each place, ``deviation`` the exact sum of
    (n * x - sum of x)**2, null where it is beyond a long, and ``identity_error`` the largest
    entry of the whitened values' covariance less the identity.

    Vectors that are null or hold a null or a value that is not finite are left out; one that
    is shorter than the longest is filled up with zeros before scaling, an empty one too.
    A place without variance, as of equal or too few vectors, has whitened value 0 and takes no
    part in ``identity_error``. Repeated rows and null ids are rows like others. An empty
    table, or one of empty vectors, gives no rows. A component whose sums are beyond a long
    fails the job. Other columns are not read.
    """
    vector = F.col(vector_col)
    kept = frame.filter(usable(vector)).select(F.col(id_col).alias("id"), whole(vector, scale, shift).alias("ints"))
    rows = numbered(kept)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("ints")).alias("width")).first()
    n, width = facts["n"], facts["width"]
    spark = frame.sparkSession
    result = f"{id_col} {kept.schema['id'].dataType.simpleString()}, n bigint, deviation bigint, values array<double>, explained array<double>, identity_error double"
    if not width:
        return spark.createDataFrame([], result)
    filled = F.concat("ints", F.array_repeat(F.lit(shift).cast("bigint"), F.lit(width) - F.size("ints")))
    rows = rows.withColumn("ints", F.when(F.size("ints") < width, filled).otherwise(F.col("ints")))
    by_place = rows.select(F.posexplode("ints").alias("place", "x")).groupBy("place")
    # one row per dimension
    sums = by_place.agg(F.sum("x").alias("total"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("place").collect()
    total = [row["total"] for row in sums]
    most = sum(max((n * row["high"] - row["total"]) ** 2, (n * row["low"] - row["total"]) ** 2) for row in sums)
    gaps = F.zip_with("ints", F.lit(total), lambda x, s: F.lit(n) * x - s)  # n times the centred vector, exact
    centred = rows.select("number", F.transform(gaps, lambda d: d / F.lit(float(n))).alias("values"))

    rows_per_block = max(BLOCK_BYTES // (8 * width), -(-n // MOST_BLOCKS), 1)
    matrix = block_matrix(centred, width, n, rows_per_block)
    covariance = scatter(matrix) / n
    values, vectors = np.linalg.eigh(covariance)
    picked = np.argsort(-values, kind="stable")[:components]
    eigen = values[picked]
    there = eigen > ROUNDING * width * max(eigen[0], 0.0)
    turn = vectors[:, picked] * np.where(there, 1 / np.sqrt(np.where(there, eigen, 1.0)), 0.0)
    trace = float(np.trace(covariance))
    explained = [float(max(e, 0.0) / trace) if trace > 0 else 0.0 for e in eigen]
    places = stored(projected(matrix, turn), "whitened")
    error = identity_error(places, [i for i, found in enumerate(there) if found])

    kind = "bigint" if most < 1 << 63 else "decimal(38,0)"
    square = F.transform(gaps, lambda d: (d.cast(kind) * d.cast(kind)).cast(kind))
    deviation = F.aggregate(square, F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))
    told = rows.select("number", "id", deviation.try_cast("bigint").alias("deviation"))
    joined = told.join(places, "number")
    return joined.select(F.col("id").alias(id_col), F.lit(n).cast("bigint").alias("n"), "deviation", "values", F.lit(explained).alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(places: DataFrame, used: list[int]) -> float:
    """The largest entry of the covariance of the ``used`` places of ``values`` less the identity; 0 without any."""
    if not used:
        return 0.0
    means = places.agg(*[F.avg(F.col("values")[i]).alias(str(i)) for i in used]).first()
    pairs = list(itertools.combinations_with_replacement(used, 2))
    less = {i: F.col("values")[i] - F.lit(means[str(i)]) for i in used}
    products = places.agg(*[F.avg(less[i] * less[j]).alias(f"{i},{j}") for i, j in pairs]).first()
    return max(abs(products[f"{i},{j}"] - (i == j)) for i, j in pairs)
