"""Whitening of vectors on MLlib's distributed block matrices.

Centred rows get gap-free indices and become the blocks of a tall BlockMatrix. Its transpose times itself is the
scatter, a matrix of dimensions squared whose eigenvectors are found on the driver; the BlockMatrix times the
whitening matrix gives the projected rows. The rows never leave the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.operators.skew import surrogate_key
from linkwright.session import written

#: Rows and columns of a block.
BLOCK_ROWS, BLOCK_COLUMNS = 2048, 1024

#: Row blocks that a task multiplies in the scatter.
BLOCKS_A_TASK = 8

#: An eigenvalue below this share of the largest one is rounding: such a component has no variance to divide by.
LEAST_SHARE = 1e-13

#: Steps per unit of a vector's entry.
STEPS = 256


def stepped(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows that take part, with ``x``: floor(256 * entry) as longs.

    The dimension is the length that most vectors have, the longest of those where several do; a vector of another
    length lacks entries, or has some too many, and takes no part, like a null one or one with null, NaN or infinite entries.
    Steps beyond a long count as its largest or smallest value.
    """
    whole = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("c")).filter(
        F.col("c").isNotNull() & (F.size("c") > 0)
        & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    sizes = whole.groupBy(F.size("c").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dims = sizes[0]["n"] if sizes else 0
    return whole.filter(F.size("c") == dims).select("vec_id", F.transform("c", lambda v: F.floor(v * STEPS)).alias("x"))


def block_matrix(rows: DataFrame, count: int, columns: int) -> BlockMatrix:
    """A BlockMatrix of rows (index, values array); ``index`` runs from 0 to ``count`` - 1."""
    indexed = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("index").cast("bigint").alias("index"), array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(indexed, count, columns).toBlockMatrix(BLOCK_ROWS, BLOCK_COLUMNS)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times itself. The row blocks are shared out over tasks, whose small products are then added."""
    tasks = max(1, -(-matrix.numRowBlocks // BLOCKS_A_TASK))
    right = matrix._java_matrix_wrapper._java_model
    left = matrix.transpose()  # held by name: the JVM drops a matrix as soon as Python has let go of its wrapper
    product = left._java_matrix_wrapper._java_model.multiply(right, tasks)
    return BlockMatrix(product, BLOCK_COLUMNS, BLOCK_COLUMNS).toLocalMatrix().toArray()


def indexed_rows(matrix: BlockMatrix) -> DataFrame:
    """(index, values) of a BlockMatrix."""
    found = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return found.toDF("index", "vector").select("index", vector_to_array("vector").alias("values"))


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over the dimensions of (n * x - S) squared, exact; null where it does not fit in a long."""
    near = 1 << 61
    s = F.array(*[F.lit(v).cast("decimal(38,0)") for v in sums])
    short = F.array(*[F.lit(v if abs(v) <= near else 0).cast("bigint") for v in sums])
    small = F.forall("x", lambda v: v.between(-(near // n), near // n)) & F.lit(all(abs(v) <= near for v in sums))
    plain = F.zip_with("x", short, lambda v, t: v * F.lit(n).cast("bigint") - t)
    exact = F.zip_with("x", s, lambda v, t: v.cast("decimal(20,0)") * F.lit(n).cast("decimal(18,0)") - t)
    apart = F.when(small, plain).otherwise(F.transform(exact, lambda d: d.try_cast("bigint")))
    size = F.aggregate(apart, F.lit(0.0), lambda total, d: total + d.cast("double") * d.cast("double"))
    fits = F.forall(apart, lambda d: d.isNotNull()) & (size < 9.2e18)
    return F.when(fits, F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d * d))


def whiten(vectors: DataFrame, keep: int = 4, vector: str = "embedding") -> DataFrame:
    """The first ``keep`` whitened components of every vector.

    The fit list holds every distinct vector of steps (``stepped``) once: n of them, with sums S per dimension. V is
    their covariance (divisor n, centred before it is multiplied), its unit eigenvectors by falling eigenvalue e are the
    components, numbered from 1. Returns a row per vector and component: vec_id, component, n, deviation (sum over the
    dimensions of (n * x - S)^2, exact; null where that is no long), whitened ((x - S / n) on the component over
    sqrt(e)), explained (e / trace(V)), identity_error (largest absolute entry of the whitened fit list's covariance
    minus the identity). Of the two signs of a component, its largest entry is positive.

    Vectors that are null, empty, hold null or non-finite entries or have another length than most are left out. A
    null or repeated vec_id and equal rows stay as they are. Vectors of fewer than ``keep`` dimensions have fewer components.
    A component without variance (fewer distinct vectors than components, or dependent dimensions) has whitened null, and takes
    no part in identity_error; with one distinct vector explained and identity_error are null. Other columns are not read;
    an empty table gives no row.

    Memory: a task holds BLOCKS_A_TASK blocks, the driver a few matrices of dimensions squared. Equal vectors
    are projected once, and their rows meet the result in a join that Spark splits where one vector is hot.
    """
    spark = vectors.sparkSession
    rows = written(stepped(vectors, vector), "steps")
    fit = surrogate_key(rows.select("x").distinct(), ["x"], "index", first=0)
    fit = written(fit, "fit")
    first = fit.select(F.size("x").alias("d")).first()
    schema = (f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, "
              "whitened double, explained double, identity_error double")
    if first is None:
        return spark.createDataFrame([], schema)
    dims = first["d"]
    totals = fit.agg(F.count(F.lit(1)), *[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(dims)]).first()
    n, sums = totals[0], [int(v) for v in totals[1:]]

    means = F.array(*[F.lit(s / n) for s in sums])
    centred = block_matrix(
        fit.select("index", F.zip_with("x", means, lambda v, m: v.cast("double") - m).alias("values")), n, dims)
    values, directions = np.linalg.eigh(scatter(centred) / n)
    values, directions = values[::-1], directions[:, ::-1]
    kept = min(keep, dims)
    trace = float(values.sum())
    good = [k for k in range(kept) if values[k] > max(values[0], 0.0) * LEAST_SHARE]
    explained = [float(max(values[k], 0.0) / trace) if trace > 0 else None for k in range(kept)]

    if good:
        signs = [1.0 if directions[np.argmax(np.abs(directions[:, k])), k] > 0 else -1.0 for k in good]
        turn = np.column_stack([directions[:, k] * sign / np.sqrt(values[k]) for k, sign in zip(good, signs)])
        whitening = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(turn)], "index long, values array<double>")
        # row blocks of the right matrix must be as tall as the column blocks of the left one
        right = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(
            whitening.select("index", array_to_vector("values").alias("vector")), "vector"), dims, len(good))
        projected = centred.multiply(right.toBlockMatrix(BLOCK_COLUMNS, BLOCK_COLUMNS))
        error = float(np.abs(scatter(projected) / n - np.eye(len(good))).max())
        fit = fit.join(indexed_rows(projected), "index")
    else:
        error = None
        fit = fit.withColumn("values", F.array().cast("array<double>"))
    place = {k: i for i, k in enumerate(good)}
    each = F.array(*[
        F.struct(F.lit(k + 1).cast("int").alias("component"),
                 (F.get("values", F.lit(place[k])) if k in place else F.lit(None).cast("double")).alias("whitened"),
                 F.lit(explained[k]).cast("double").alias("explained"))
        for k in range(kept)])
    done = written(fit.select("x", _deviation(n, sums).alias("deviation"), each.alias("each")), "whitened")
    return (
        rows.join(done, "x").select("vec_id", "deviation", F.explode("each").alias("e"))
        .select("vec_id", "e.component", F.lit(n).cast("bigint").alias("n"), "deviation", "e.whitened", "e.explained",
                F.lit(error).cast("double").alias("identity_error"))
    )
