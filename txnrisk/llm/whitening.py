"""Embedding whitening with MLlib block matrices.

Entries are fixed-point numbers, so sums are exact. Centred rows are indexed and cut into distributed blocks;
the transposed matrix times the matrix is the scatter; its eigenvectors are found on the driver (its size is
that of one vector squared), and the block matrix times the scaled eigenvectors projects all rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import saved

#: Steps of a fixed-point entry, and what is added to it.
STEP, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Least rows of a block; more where there would be over so many blocks, as the driver has a list of them.
BLOCK_ROWS, MOST_BLOCKS = 1024, 1 << 16
BLOCK_COLUMNS = 1024
#: Blocks that a task multiplies for the scatter.
BLOCKS_A_TASK = 4
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def fixed_point(vectors: DataFrame) -> DataFrame:
    """(index, vec_id, x) of whole rows; indexes are gapless from 0 and the table is written, so they stay."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.col("e").isNotNull() & F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = rows.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    usual = lengths.first()
    x = F.transform("e", lambda c: F.floor(c * STEP).cast("long") + SHIFT)
    rows = rows.where(F.size("e") == (usual.d if usual else 0)).select("vec_id", x.alias("x"))
    rows = saved(rows.withColumn("at", F.monotonically_increasing_id()), "fixed-point")
    part, place = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # A row for each partition of the scan; the window sees only these.
    parts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = saved(parts.select("part", first.alias("first")), "partitions")
    indexed = rows.withColumn("part", part).join(F.broadcast(parts), "part")
    return saved(indexed.select((F.col("first") + place).alias("index"), "vec_id", "x"), "indexed")


def block_matrix(rows: DataFrame, values: Column, n: int, d: int) -> BlockMatrix:
    """A block matrix of rows (index, array of doubles), made in the JVM."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(values).alias("vector")), "vector")
    per_block = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    matrix = IndexedRowMatrix(vectors, n, d).toBlockMatrix(per_block, min(d, BLOCK_COLUMNS))
    return matrix.persist(StorageLevel.MEMORY_AND_DISK)  # used several times; a lost block is made again from the table


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix. The middle dimension is split, as else one task would get all rows."""
    left, right = matrix.transpose(), matrix
    splits = max(1, math.ceil(matrix.numRowBlocks / BLOCKS_A_TASK))
    product = left._java_matrix_wrapper._java_model.multiply(right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def project(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """(index, w): rows of the matrix times ``weights``."""
    spark, step = matrix.blocks.ctx, matrix.colsPerBlock
    cut = [((i, 0), DenseMatrix(len(part), part.shape[1], part.ravel("F"))) for i, part in enumerate(np.split(weights, range(step, len(weights), step)))]
    factor = BlockMatrix(spark.parallelize(cut, 1), step, weights.shape[1])
    rows = callMLlibFunc("getIndexedRows", matrix.multiply(factor).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("index"), vector_to_array("vector").alias("w"))


def _free(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row of ``SCHEMA`` for each vector of (vec_id, embedding) and component, by falling eigenvalue.

    Vectors that are null or hold null or non-finite entries are dropped, and so are those of another length than
    the most usual (of equally usual lengths the largest), as they have no place in the covariance. Components without
    variance beyond rounding have no whitened value and are left out, so a single vector or equal vectors give no rows.
    Repeated rows and ids count as often as they stand there; a null vec_id stays null; other columns aren't read. A
    deviation that no long can hold is null. An empty table gives an empty result.
    """
    spark, rows = vectors.sparkSession, fixed_point(vectors)
    head = rows.first()
    d = len(head.x) if head else 0
    if not d:
        return spark.createDataFrame([], SCHEMA)
    n, *sums = rows.agg(F.count("*"), *(F.sum(F.get("x", F.lit(i))) for i in range(d))).first()
    # n * x - S is exact; one division rounds it.
    away = F.zip_with("x", F.array(*(F.lit(int(s)) for s in sums)), lambda x, s: x * n - s)
    centred = F.transform(away, lambda a: a.cast("double") / n)
    matrix = block_matrix(rows, centred, n, d)
    values, directions = np.linalg.eigh(scatter(matrix) / n)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(most, int((values > d * np.finfo(float).eps * max(values[0], 0)).sum()))
    if not k:
        _free(matrix)
        return spark.createDataFrame([], SCHEMA)
    whitened = saved(project(matrix, directions[:, :k] / np.sqrt(values[:k])), "whitened")
    _free(matrix)
    means = np.array(whitened.agg(*(F.avg(F.get("w", F.lit(i))) for i in range(k))).first(), dtype=float)
    matrix = block_matrix(whitened, F.col("w"), n, k)
    covariance = scatter(matrix) / n - np.outer(means, means)
    _free(matrix)
    error = float(np.abs(covariance - np.eye(k)).max())
    exact = F.transform(away, lambda a: a.cast("decimal(19,0)"))
    deviation = F.aggregate(exact, F.lit(0).cast("decimal(38,0)"), lambda s, a: (s + a * a).cast("decimal(38,0)")).try_cast("long")
    own = rows.select("index", "vec_id", deviation.alias("deviation"))
    share = F.array(*(F.lit(float(v)) for v in values[:k] / values.sum()))
    out = whitened.join(own, "index").select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
