"""Embedding whitening with MLlib's distributed block matrices.

Vectors become whole numbers, so that means and squared distances are exact;
the centred rows get consecutive indexes and go into a BlockMatrix of blocks
of ``block_rows`` rows. Its transpose times itself is the scatter matrix, whose
eigenvectors (a local matrix of the dimension squared) make the whitening
matrix; the block matrix times that one projects all rows, and the projected
rows' own scatter gives the error that is reported.

The product over the rows is split into as many parts as there are tasks
worth of blocks, each with a partial sum of the dimension squared, so no task
holds more than its blocks. Rows become blocks and results become rows again in
the JVM. MLlib lists block numbers (not rows) on the driver: n / block_rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import named, stored
from metroframe.llm.topk import finite

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 4096
#: blocks of the rows that one task multiplies
BLOCKS_A_TASK = 8
#: a component of a smaller share of the largest eigenvalue has no direction of its own
FLAT = 1e-12


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x): the usable vectors as whole numbers floor(scale * c) + shift."""
    rows = df.select(named(id_col).alias("vec_id"), named(vector_col).alias("vector"))
    rows = rows.where(finite(F.col("vector")) & (F.size("vector") > 0))
    return rows.select("vec_id", F.transform("vector", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("long")).alias("x"))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with consecutive numbers in ``index``: each task's rows are
    numbered on their own, and a prefix sum over the tasks' counts shifts them."""
    mark = F.monotonically_increasing_id()
    kept = stored(rows.withColumn("part", F.shiftright(mark, 33).cast("int")).withColumn("index", mark.bitwiseAND((1 << 33) - 1)), "whitening-rows")
    counts = kept.groupBy("part").agg((F.max("index") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that wrote
    shift = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return stored(kept.join(stored(shift, "whitening-shifts"), "part").withColumn("index", F.col("index") + F.col("shift")).drop("part", "shift"), "whitening-indexed")


def block_matrix(rows: DataFrame, n: int, dims: int, block_rows: int) -> BlockMatrix:
    """Rows (index, array of doubles) as a block matrix of one block column."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("row").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(block_rows, dims)


def scatter(matrix: BlockMatrix, blocks_a_task: int) -> np.ndarray:
    """The transpose of ``matrix`` times ``matrix``, as a local matrix."""
    parts = max(1, -(-int(matrix.numRowBlocks) // blocks_a_task))
    # the Python method has no argument for the number of parts of the middle dimension
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
           block_rows: int = BLOCK_ROWS, blocks_a_task: int = BLOCKS_A_TASK) -> DataFrame:
    """One row per usable row of ``df``: vec_id, n, deviation, whitened,
    explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are left
    out, as are those of another length than the commonest (of equally common
    ones the longest). n counts the rest; ``deviation`` is the exact sum of
    (n * x - S)^2 over the dimensions, null where a long cannot hold it.
    ``whitened`` and ``explained`` are arrays over the components by falling
    eigenvalue, at most ``components``: the coordinate over the eigenvalue's
    root, and the eigenvalue's share of all. Components without variance (under
    FLAT of the largest eigenvalue) are left out, so one vector, or equal ones
    only, have empty arrays. ``identity_error`` is the largest difference of the
    whitened rows' covariance from the identity (null without components).
    Repeated rows and null ids count and stay like any other; an empty table
    gives no rows. Other columns are not read."""
    spark = df.sparkSession
    usable = stored(whole_vectors(df, id_col, vector_col, scale, shift), "whitening-whole")
    lengths = usable.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    id_type = usable.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    n, dims = int(lengths.n), int(lengths.dims)
    rows = indexed(usable.where(F.size("x") == dims))
    sums = [int(s) for s in rows.agg(*(F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(dims))).first()]

    total = F.array(*(F.lit(s) for s in sums))
    # n * x - S is a whole number: centred without a rounding of the mean
    moved = F.zip_with("x", total, lambda x, s: x * F.lit(n) - s)
    square = F.aggregate(F.transform(F.col("moved"), lambda m: m.cast("decimal(19,0)") * m.cast("decimal(19,0)")),
                         F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"))
    own = rows.select("vec_id", "index", moved.alias("moved"))
    own = own.select("vec_id", "index", square.try_cast("long").alias("deviation"), F.transform("moved", lambda m: m / F.lit(float(n))).alias("row"))

    matrix = block_matrix(own, n, dims, block_rows)
    values, vectors = np.linalg.eigh(scatter(matrix, blocks_a_task) / n)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    kept = int(((values > FLAT * values[0]) & (values > 0)).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    if not kept:
        none = F.array().cast("array<double>")
        return own.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", none.alias("whitened"), none.alias("explained"), F.lit(None).cast("double").alias("identity_error"))
    explained = (values[:kept] / values.clip(min=0).sum()).tolist()
    weights = vectors[:, :kept] / np.sqrt(values[:kept])
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(dims, kept, weights.ravel(order="F").tolist()))], 1), dims, kept)
    projected = matrix.multiply(right)
    back = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    back = MLUtils.convertVectorColumnsToML(back.toDF("index", "vector"), "vector").select("index", vector_to_array("vector").alias("whitened"))
    back = stored(back, "whitened")
    again = block_matrix(back.withColumnRenamed("whitened", "row"), n, kept, block_rows)
    error = float(np.abs(scatter(again, blocks_a_task) / n - np.eye(kept)).max())
    return own.join(back, "index").select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                                          F.array(*(F.lit(e) for e in explained)).alias("explained"), F.lit(error).alias("identity_error"))
