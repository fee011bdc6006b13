"""Usable vectors of a table, with a digest that stands for the vector."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.tables import bounded_batches


def lists(column):
    """(values as doubles, bounds of the lists) of an Arrow column of lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), ends


def matrix(column, rows, size):
    """The lists at ``rows``, all of one size, as a matrix of doubles."""
    flat, ends = lists(column)
    return flat[ends[rows][:, None] + np.arange(size)].astype(float)


def finite(vector):
    """Whether an array has neither nulls nor values that are not finite."""
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)), F.lit(False))


def keyed(vector, change=None, kind="double"):
    """struct<v, key>: an array<double> changed by a numpy function, and 128 bits of digest of its values.

    Equal vectors have equal digests (0.0 and -0.0 are equal).
    """

    def run(column):
        flat, ends = lists(column)
        flat = (flat if change is None else change(flat)) + 0
        flat = flat.astype(np.int64 if kind == "bigint" else np.float64)
        data = memoryview(np.ascontiguousarray(flat)).cast("B")
        keys = [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([values, pa.array(keys, pa.binary())], ["v", "key"])

    return F.arrow_udf(run, f"struct<v: array<{kind}>, key: binary>")(vector)


def usable(df, id_col, vector_col, change=None, kind="double", more=()):
    """(id, key, v, *more) of the rows whose vector is there and finite; ``more`` are named columns."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), *more, F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("x").isNotNull()).filter(finite("x"))
    names = [c for c in rows.columns if c not in ("id", "x")]
    return rows.withColumn("x", keyed(F.col("x"), change, kind)).select("id", "x.key", "x.v", *names)
