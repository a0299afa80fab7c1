"""Whitening of embeddings with distributed block matrices.

The centred rows form a ``BlockMatrix`` of Spark MLlib. Its transpose times itself, with the long dimension cut into
splits, is the scatter matrix; only that matrix, of the vectors' width, reaches the driver for its eigenvectors. The block
matrix times the whitening matrix projects all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.sources.session import constant_frame, staged

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
BLOCK_BYTES = 1 << 21
BLOCKS_PER_SPLIT = 8
LARGEST = float(1 << 62)  # of scaled entries: what a long holds, with room for the offset
FLAT = 1e-12  # share of the whole variance below which a component has none
SCHEMA = (f"{{id}} long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double, deviation_exact decimal(38,0)")


def scaled_rows(df: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(id, x): whole-number vectors of the rows that take part."""
    c = F.transform(vector_col, lambda v: v.cast("double") * scale)
    bad = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LARGEST))
    return (df.select(F.col(id_col).cast("long").alias("id"), c.alias("c")).filter(F.col("c").isNotNull() & ~bad)
            .select("id", F.transform("c", lambda v: F.floor(v).cast("long") + offset).alias("x")))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written once, with consecutive numbers in ``row`` that stay when tasks run again."""
    written = staged(rows.withColumn("part", F.spark_partition_id()).withColumn(
        "at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "whitening-rows")
    # One row per task of the writing job.
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    first = written.groupBy("part").agg(F.count("*").alias("size")).select("part", before.alias("before"))
    return written.join(F.broadcast(first), "part").select((F.col("before") + F.col("at")).alias("row"), "id", "x")


def centred(rows: DataFrame, n: int, sums: list[int], largest: int) -> DataFrame:
    """(row, id, exact, c): the exact sum of squares of n*x - S as text, and x - S/n.

    ``largest`` bounds |x|; 64 bits are used where they hold every step, Python's whole numbers elsewhere.
    """
    width = len(sums)
    most = 2 * n * (largest + 1)
    safe = most < 1 << 62 and width * most * most < 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(sums, np.int64 if safe else object)
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            far = (x if safe else x.astype(object)) * n - s
            exact = [str(v) for v in (far * far).sum(axis=1).tolist()]
            c = np.ascontiguousarray((far / n).astype(np.float64))
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(exact, pa.string()),
                 pa.ListArray.from_arrays(ends, pa.array(c.ravel()))], names=["row", "id", "exact", "c"])

    return rows.select("row", "id", "x").mapInArrow(run, "row long, id long, exact string, c array<double>")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The vectors ``c`` of numbered rows as blocks over the whole width."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector("c").alias("c")), "c")
    per_block = max(64, BLOCK_BYTES // (8 * width))
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(per_block, width)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix. The long dimension is summed in splits of few blocks, not in one task."""
    splits = max(1, -(-blocks.numRowBlocks // BLOCKS_PER_SPLIT))
    java = blocks._java_matrix_wrapper._java_model
    product = java.transpose().multiply(java, splits).toLocalMatrix()
    flat = np.array(list(product.toArray()), np.float64)
    return flat.reshape(product.numCols(), product.numRows()).T


def rows_of(blocks: BlockMatrix) -> DataFrame:
    """(row, w): the rows of a block matrix; they do not pass through Python."""
    java = blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    index, vector = (frame := callMLlibFunc("getIndexedRows", java)).columns
    return frame.select(F.col(index).alias("row"), vector_to_array(F.col(vector)).alias("w"))


def whitening_matrix(variance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(directions over the root of their variance, shares of the whole variance), by falling variance.

    Directions point so that their largest entry is positive. Those without variance have a share but no column.
    """
    values, vectors = np.linalg.eigh((variance + variance.T) / 2)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    whole = max(float(np.trace(variance)), 0.0)
    shares = values[:components] / whole if whole else np.zeros(min(components, len(values)))
    kept = int((shares > FLAT).sum())
    vectors = vectors[:, :kept]
    if kept:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0)
    return vectors / np.sqrt(values[:kept]), shares


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Per row and component: id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_exact.

    An entry c counts as x = floor(scale * c) + offset. Rows whose vector is null, holds null or non-finite entries or
    entries whose x is no 64-bit number, take no part. Shorter vectors count as padded with 0. Repeated rows and rows
    without an id take part like others. Other columns are not read.

    ``deviation`` is the sum over all dimensions of (n*x - S)^2, null if it needs more than 64 bits; ``deviation_exact``
    then still holds it, up to 38 digits. ``identity_error`` is measured on the whitened rows: the largest entry of their
    covariance minus the identity. A component without variance has a null ``whitened`` and an ``explained`` of 0.
    An empty table gives no rows; vectors without entries have no components.
    """
    spark, schema = df.sparkSession, SCHEMA.format(id=id_col)
    rows = scaled_rows(df, id_col, vector_col, scale, offset)
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return constant_frame(spark, [], schema)
    pad = F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size("x"))
    rows = numbered(rows.select("id", F.concat("x", pad).alias("x")))
    # One row per dimension.
    sums = (rows.select(F.posexplode("x").alias("at", "v")).groupBy("at")
            .agg(F.sum(F.col("v").cast("decimal(19,0)")).alias("s"), F.count("*").alias("n"),
                 F.min("v").alias("low"), F.max("v").alias("high")).orderBy("at").collect())
    n, largest = sums[0]["n"], max(max(abs(r["low"]), abs(r["high"])) for r in sums)
    ready = centred(rows, n, [int(r["s"]) for r in sums], largest)

    blocks = block_matrix(ready, n, width)
    matrix, shares = whitening_matrix(scatter(blocks) / n, components)
    kept = matrix.shape[1]
    facts = ready.select("row", "id", F.col("exact").try_cast("long").alias("deviation"),
                         F.col("exact").try_cast("decimal(38,0)").alias("deviation_exact"))
    if kept:
        factor = BlockMatrix(spark.sparkContext.parallelize(
            [((0, 0), Matrices.dense(width, kept, matrix.T.ravel().tolist()))], 1), width, kept, width, kept)
        white = blocks.multiply(factor)
        error = float(np.abs(scatter(white) / n - np.eye(kept)).max())
        joined = facts.join(rows_of(white), "row")
    else:
        error, joined = 0.0, facts.withColumn("w", F.array().cast("array<double>"))
    share = F.array(*[F.lit(float(s)) for s in shares])
    return (joined.withColumn("component", F.explode(F.sequence(F.lit(1), F.lit(len(shares)))))
            .select(F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation",
                    F.get("w", F.col("component") - 1).alias("whitened"),
                    F.get(share, F.col("component") - 1).alias("explained"),
                    F.lit(error).alias("identity_error"), "deviation_exact"))
