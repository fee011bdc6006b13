"""Whitening of embeddings with distributed block matrices.

1. Entries become integers, x = floor(SCALE * c) + OFFSET. Equal x vectors are one row of the fit
   list. Its size n and the sums S of the dimensions are exact integers.
2. The fit list gets a dense index, and its centred rows, x - S/n, go into an IndexedRowMatrix and
   from there into a BlockMatrix: blocks of BLOCK_ROWS rows, of more only where there would be more
   than MOST_BLOCKS (the driver lists the blocks' coordinates for a product).
3. The transposed matrix times the matrix is the scatter. The middle dimension of the product is
   split, so that a task multiplies at most SPLIT_BLOCKS blocks and only d x d sums are combined.
4. The driver takes the d x d scatter, finds eigenvectors, and shares the d x k whitening matrix as a
   BlockMatrix; a second product projects the rows. A third one, of the projected rows with
   themselves, gives the covariance whose distance from the identity is reported.

Defined cases: null vectors and vectors with null or non-finite entries are dropped; null ids and
repeated rows stay; entries of x that do not fit 62 bits are cut to them, as are deviations that do
not fit 64; each length of vector is whitened on its own (empty vectors have no components, so no
rows); a component without variance has a null ``whitened`` and no part in the error, and without
any variance ``explained`` is null, too. An empty table has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import written
from shelfcast.llm.vectors import lists, usable

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 1_024
BLOCK_COLUMNS = 1_024
MOST_BLOCKS = 65_536
SPLIT_BLOCKS = 16
LARGEST = 2.0**62
KIND = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _scaled(scale, offset):
    return lambda c: np.clip(np.floor(np.clip(c * float(scale), -LARGEST, LARGEST)) + float(offset), -LARGEST, LARGEST)


def _sums(size):
    """Exact sums of a task's rows, one row of numerals."""

    def run(batches):
        total, count = [0] * size, 0
        for batch in batches:
            flat, _ = lists(batch.column(0))
            x = flat.reshape(-1, size)
            count += len(x)
            if not len(x):
                continue
            most = max(abs(int(x.max())), abs(int(x.min())))
            part = x.sum(axis=0) if most * len(x) < 2**63 else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([[str(t) for t in total]]), pa.array([count])], ["sums", "n"])

    return run


def column_sums(fit, size):
    """(n, exact sums of each dimension as Python integers)."""
    parts = fit.select("v").mapInArrow(_sums(size), "sums array<string>, n bigint")
    places = parts.select("n", F.posexplode("sums").alias("at", "part"))
    rows = places.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * size
    for r in rows:
        sums[r["at"]] = int(r["s"])
    return (rows[0]["n"] if rows else 0), sums


def _centred(n, sums):
    """Rows less their mean: integers first, so that nothing is lost to the size of the mean."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])

    def run(column):
        flat, ends = lists(column)
        x = flat.reshape(-1, len(whole))
        out = (x - whole).astype(float) - part
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out.ravel()))

    return F.arrow_udf(run, "array<double>")


def _deviation(n, sums):
    """Sum over the dimensions of (n x - S)^2."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def run(column):
        flat, _ = lists(column)
        x = flat.reshape(-1, len(whole))
        near = x - whole
        most = n * (int(np.abs(near).max(initial=0)) + 1)
        if len(whole) * most * most < 2**63:
            out = ((n * near - rest) ** 2).sum(axis=1)
        else:
            big = near.astype(object) * n - rest.astype(object)
            out = [min(int(t), 2**63 - 1) for t in (big * big).sum(axis=1)]
        return pa.array(out, pa.int64())

    return F.arrow_udf(run, "bigint")


def indexed(df, name="index"):
    """The table, written, with a dense number of each row from 0."""
    table = written(df.withColumn("at", F.monotonically_increasing_id()), "indexed")
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit(2**33 - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each written part
    starts = table.groupBy(part).agg(F.count("*").alias("rows"))
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    found = table.withColumn("part", F.shiftright("at", 33)).join(starts, "part")
    return found.withColumn(name, F.col("start") + place).drop("at", "part", "start")


def block_matrix(rows, n, size):
    """A BlockMatrix of (index, array of doubles) rows."""
    per_block = max(BLOCK_ROWS, math.ceil(n / MOST_BLOCKS))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("y").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, size).toBlockMatrix(per_block, min(size, BLOCK_COLUMNS))


def gram(blocks, splits):
    """The local matrix of a BlockMatrix's transpose times itself."""
    left, right = blocks.transpose()._java_matrix_wrapper, blocks._java_matrix_wrapper._java_model
    product = BlockMatrix(left.call("multiply", right, splits), blocks.colsPerBlock, blocks.colsPerBlock)
    return product.toLocalMatrix().toArray()


def _shared_matrix(spark, values, rows_per_block):
    """A local matrix as a BlockMatrix of blocks of whole rows."""
    size, width = values.shape
    blocks = [
        ((at // rows_per_block, 0), Matrices.dense(len(part), width, part.ravel(order="F").tolist()))
        for at in range(0, size, rows_per_block)
        for part in [values[at : at + rows_per_block]]
    ]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), rows_per_block, width, size, width)


def eigen(scatter, n, components):
    """(eigenvectors as columns, eigenvalues, trace) of scatter / n by falling eigenvalue; the largest entry is positive."""
    cov = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return vectors * signs, values, float(np.trace(cov))


def _whiten(spark, rows, size, components):
    """Result rows of the vectors of one size."""
    fit = indexed(rows.groupBy("key").agg(F.any_value("v").alias("v")))
    n, sums = column_sums(fit, size)
    centred = written(fit.select("index", _centred(n, sums)("v").alias("y")), "centred")
    blocks = block_matrix(centred, n, size).persist(StorageLevel.MEMORY_AND_DISK)  # each product lists and reads them
    splits = max(1, math.ceil(n / blocks.rowsPerBlock / SPLIT_BLOCKS))
    vectors, values, trace = eigen(gram(blocks, splits), n, components)
    real = values > max(values[0], 0.0) * size * np.finfo(float).eps if len(values) else np.zeros(0, bool)
    width = int(real.sum())  # the leading ones
    out = fit.select("key", "index", _deviation(n, sums)("v").alias("deviation"))
    error = None
    if width:
        whitening = _shared_matrix(spark, vectors[:, :width] / np.sqrt(values[:width]), blocks.colsPerBlock)
        projected = blocks.multiply(whitening)
        table = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        table = written(table.select("index", vector_to_array("vector").alias("z")), "projected")
        white = block_matrix(table.select("index", F.col("z").alias("y")), n, width).persist(StorageLevel.MEMORY_AND_DISK)
        error = float(np.abs(gram(white, splits) / n - np.eye(width)).max())
        white._java_matrix_wrapper._java_model.blocks().unpersist(False)
        out = out.join(table, "index")
    else:
        out = out.withColumn("z", F.array().cast("array<double>"))
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in values]
    shares = F.array(*[F.lit(v).cast("double") for v in explained])
    out = written(out.select("key", "deviation", "z"), "classes")
    found = rows.select("id", "key").join(out, "key").select("id", "deviation", "z", F.posexplode(shares).alias("at", "explained"))
    return found.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.get("z", F.col("at")).alias("whitened"),
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten(df, id_col="vec_id", vector_col="embedding", components=COMPONENTS, scale=SCALE, offset=OFFSET):
    """For each usable row and component: n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, _scaled(scale, offset), "bigint").withColumn("size", F.size("v"))
    rows = written(rows, "vectors")
    out = spark.createDataFrame([], KIND)
    for size in sorted(r["size"] for r in rows.select("size").distinct().collect()):  # usually one
        if size:
            out = out.union(_whiten(spark, rows.filter(F.col("size") == size), size, components))
    return out


def op11_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
