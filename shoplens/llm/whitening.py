"""Embedding whitening with MLlib block matrices.

Entries are put on a whole-number grid. The distinct vectors are the fit list;
its size and sums are exact, so rows are centred exactly before anything is
multiplied. The centred rows are indexed into distributed blocks, the transposed
blocks times the blocks give the scatter matrix, which alone (width squared) is
decomposed on the driver, and the blocks times the whitening matrix project all
rows. Rows pass between DataFrames and block matrices inside the JVM. The
covariance of the projected fit list, computed the same way, gives the largest
departure from the identity.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import save

#: Grid steps per unit, and the shift that makes entries positive.
STEPS, SHIFT = 64, 1_000_000
#: Most components; an eigenvalue below this part of the largest is no component.
COMPONENTS, LEAST_SHARE = 16, 1e-10
#: Entries of a block (8 bytes each) and most columns of one.
BLOCK_ENTRIES, BLOCK_COLUMNS = 1 << 20, 1024
#: Tasks that add up the products of a scatter matrix.
SPLITS = 64
#: Entries above this size have no place on the grid: sums of their squares could not be exact.
LARGEST = 2.0**40


def on_grid(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): floor(64 c) + 1000000 of the usable vectors' entries, as whole numbers."""
    c = F.col("embedding")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > LARGEST))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * STEPS) + SHIFT)
    return vectors.select("vec_id", "embedding").where(c.isNotNull() & (F.size(c) > 0) & ~bad).select("vec_id", x.alias("x"))


def indexed(rows: DataFrame, name: str) -> DataFrame:
    """The stored rows with ``index`` 0, 1, ...: one offset per partition passes through the driver."""
    stored = save(rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    runs = sorted(tuple(r) for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in runs]).tolist()
    shifts = rows.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(runs, before, strict=False)], "part long, before long")
    return (stored.join(F.broadcast(shifts), part == F.col("part"))
            .withColumn("index", F.col("before") + F.col("at") - F.shiftleft("part", 33)).drop("at", "part", "before"))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def block_matrix(rows: DataFrame, values: Column, n_rows: int, width: int) -> BlockMatrix:
    """Blocks of the rows at ``index``; indices without a row are rows of zeros."""
    made = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(values).alias("vector")), "vector")
    columns = min(width, BLOCK_COLUMNS)
    matrix = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", made, n_rows, width))
    return matrix.toBlockMatrix(max(1, BLOCK_ENTRIES // columns), columns)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transposed blocks times blocks; the products are added up over ``SPLITS`` tasks."""
    left = blocks.transpose()._java_matrix_wrapper._java_model
    product = left.multiply(blocks._java_matrix_wrapper._java_model, SPLITS)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def projected(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """(index, y): the block rows times a local matrix."""
    step, (width, k) = blocks.colsPerBlock, matrix.shape
    parts = [((i, 0), DenseMatrix(min(step, width - at), k, matrix[at:at + step].ravel(order="F"))) for i, at in enumerate(range(0, width, step))]
    from pyspark.sql import SparkSession
    local = BlockMatrix(SparkSession.active().sparkContext.parallelize(parts, len(parts)), step, k, width, k)
    rows = callMLlibFunc("getIndexedRows", blocks.multiply(local).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("y"))


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(width x k matrix of unit eigenvectors over the roots of their eigenvalues, explained shares), largest first."""
    value, vector = np.linalg.eigh((covariance + covariance.T) / 2)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    kept = value > LEAST_SHARE * max(value[0], 0.0)
    return vector[:, kept] / np.sqrt(value[kept]), value[kept] / np.trace(covariance)


OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _whiten(rows: DataFrame, fit: DataFrame, n_rows: int, width: int, components: int) -> DataFrame | None:
    """Output rows of the vectors of one width; None if their covariance is zero."""
    sums = fit.select(F.posexplode("x").alias("dim", "v")).groupBy("dim").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    n, total = sums[0]["n"], _longs([r["s"] for r in sums])
    away = F.zip_with("x", total, lambda v, s: v * n - s)  # n times the centred entry, exact
    centred = F.transform(away, lambda v: v.cast("double") / float(n))
    covariance = scatter(block_matrix(fit, centred, n_rows, width)) / n
    if not covariance.any():
        return None
    matrix, explained = whitening_matrix(covariance, components)
    k = matrix.shape[1]
    white = save(projected(block_matrix(rows, centred, n_rows, width), matrix), "whitening-projected")
    own = white.join(fit.select("index"), "index", "left_semi")
    means = own.agg(*[F.avg(F.col("y")[j]).alias(f"m{j}") for j in range(k)]).first()
    own = own.select("index", F.zip_with("y", F.array(*[F.lit(m) for m in means]), lambda y, m: y - m).alias("y"))
    error = float(np.abs(scatter(block_matrix(own, F.col("y"), n_rows, k)) / n - np.eye(k)).max())
    square = F.aggregate(F.transform(away, lambda v: v.cast("decimal(19,0)")), F.lit(0).cast("decimal(38,0)"), lambda s, v: (s + v * v).cast("decimal(38,0)"))
    joined = rows.select("vec_id", "index", square.alias("deviation")).join(white, "index")
    return (joined.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*[F.lit(float(e)) for e in explained])[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``vectors`` needs vec_id and embedding; other columns are ignored. A vector
    that is null or empty, or holds an entry that is null, not finite or above
    2^40 in size, gives no rows. Vectors of each length are a table of their own,
    fitted on its distinct vectors. Repeated rows and null ids give rows each.
    Components are those with an eigenvalue above 10^-10 of the largest, at most
    ``components``; equal vectors only, or an empty table, give no rows.
    ``deviation`` is exact in a decimal of 38 digits.
    """
    rows = indexed(on_grid(vectors), "whitening-rows")
    sizes = sorted(tuple(r) for r in rows.groupBy(F.size("x").alias("width")).agg(F.max("index")).collect())
    parts = []
    for width, last in sizes:
        own = rows.where(F.size("x") == width)
        fit = save(own.groupBy("x").agg(F.min("index").alias("index")), "whitening-fit")
        parts.append(_whiten(own, fit, last + 1, width, components))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = vectors.sparkSession.createDataFrame([], f"vec_id {kind}, {OUT}")
    for part in parts:
        out = out if part is None else out.unionByName(part)
    return out
