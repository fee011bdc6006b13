"""Exact top-k inner products with vector-approximation files.

Components become integers, floor(256 x). The approximation of a vector is the number of the cell
of each component, one byte each; cell marks are quantiles over all components. For a query, cells
give an upper and a lower bound of the inner product. A block of queries scans the approximations
twice: the first scan finds each query's k-th best lower bound over all vectors, the second returns
the vectors whose upper bound reaches it. Their exact vectors are then read in the order of upper
bounds: first FIRST * k for each query, and of the others only those whose bound still reaches the
k-th exact score. So the result is exact.

Queries go in blocks of QUERY_BLOCK at most (a bounded broadcast); each block scans all vectors.
Vectors that occur often count once: beyond the k + 1 smallest ids of equal vectors none can be
among k results (Spark cuts these groups on the map side, before they are shuffled).

Defined cases: null vectors, vectors with null or non-finite components and null ids take no part;
vectors of different lengths are not compared; a row is not compared with rows of its own id;
repeated rows count once, and of an id with several vectors the smallest is the query; scores that
do not fit 64 bits are cut to their range; a query without candidates has no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import written

SCALE = 256
CELLS = 64
QUERY_BLOCK = 8_192
FIRST = 3
STEP = 512
EXACT = 2.0**25  # components below it give exact sums in 64 bits


def usable(df, id_col, vector_col):
    """(id, v): v holds floor(SCALE * x) as doubles."""
    inf = F.lit(float("inf"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull()).filter(finite)
    scaled = F.arrow_udf(lambda x: _map_lists(x, lambda v: np.floor(v * SCALE)), "array<double>")
    return rows.select("id", scaled("x").alias("v"))


def _map_lists(lists, f):
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = f(lists.flatten().to_numpy(zero_copy_only=False))
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.float64()))


def cell_marks(vectors):
    """Ascending bounds of the cells: quantiles of all components, with the extremes."""
    parts = vectors.select(F.explode("v").alias("c"))
    steps = [i / CELLS for i in range(1, CELLS)]
    low, high, inner = parts.agg(F.min("c"), F.max("c"), F.percentile_approx("c", F.array(*[F.lit(s) for s in steps]), 1000)).first()
    if low is None:
        return np.array([0.0, 0.0])
    marks = np.unique([low, *inner, high])
    return marks if len(marks) > 1 else np.array([low, high])


def _codes(marks):
    def of(v):
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        cells = np.clip(np.searchsorted(marks, v.flatten().to_numpy(zero_copy_only=False), "right") - 1, 0, len(marks) - 2).astype(np.uint8)
        ends = np.concatenate(([0], np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))))
        return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cells)])

    return F.arrow_udf(of, "binary")


class _Scan:
    """Bounds of the inner products of approximated vectors with a block of queries."""

    def __init__(self, block, marks):
        self.block, self.marks = block, marks

    def bounds(self, batch):
        """(ids of vectors, places of queries in the block, lower, upper) in parts of bounded size."""
        ids = batch.column(0).to_numpy()
        codes = batch.column(1)
        lengths = pc.binary_length(codes).to_numpy()
        flat = np.frombuffer(b"".join(codes.to_pylist()), np.uint8)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        for size in np.unique(lengths):
            if size not in self.block:
                continue
            places, _, queries = self.block[size]
            rows = np.flatnonzero(lengths == size)
            for at in range(0, len(rows), STEP):
                part = rows[at : at + STEP]
                cells = np.stack([flat[starts[r] : starts[r] + size] for r in part]).astype(np.intp)
                low, high = self.marks[cells], self.marks[cells + 1]
                for q in range(0, len(places), STEP):
                    up, down = np.maximum(queries[q : q + STEP], 0), np.minimum(queries[q : q + STEP], 0)
                    most = up @ high.T + down @ low.T
                    least = up @ low.T + down @ high.T
                    slack = 1e-12 * (np.abs(most) + np.abs(least)) if np.abs(most).max(initial=0) > 2**52 else 0
                    yield ids[part], places[q : q + STEP], least - slack, most + slack


def _block(rows):
    """Queries by length: (places in ``ids``, ids, matrix)."""
    out = {}
    for size in {len(r["v"]) for r in rows}:
        places = np.array([i for i, r in enumerate(rows) if len(r["v"]) == size])
        out[size] = (places, np.array([rows[i]["id"] for i in places]), np.array([rows[i]["v"] for i in places], float).reshape(len(places), size))
    return out


def _best_lower(shared, k):
    """For each query of the block its k best lower bounds among a task's vectors."""

    def run(batches):
        block, marks, ids = shared.value
        best = np.full((len(ids), k), -np.inf)
        for batch in batches:
            for own, places, least, _ in _Scan(block, marks).bounds(batch):
                least = np.where(own[None, :] == ids[places][:, None], -np.inf, least)
                both = np.concatenate((best[places], least), axis=1)
                best[places] = -np.partition(-both, k - 1, axis=1)[:, :k]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, best.size + 1, k), pa.int32()), pa.array(best.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ids))), lists], ["place", "best"])

    return run


def _reaching(shared, limits):
    """The vectors whose upper bound reaches the query's limit."""

    def run(batches):
        block, marks, ids = shared.value
        for batch in batches:
            for own, places, _, most in _Scan(block, marks).bounds(batch):
                q, v = np.nonzero((most >= limits.value[places][:, None]) & (own[None, :] != ids[places][:, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[places[q]]), pa.array(places[q]), pa.array(own[v]), pa.array(most[q, v])], ["query_id", "place", "id", "most"]
                )

    return run


def _exact(shared):
    """Inner products of the vectors in ``v`` with the queries in ``place``."""

    def of(place, v):
        block, _, _ = shared.value
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        place, lengths, flat = place.to_numpy(), v.value_lengths().to_numpy(), v.flatten().to_numpy()
        starts, out = np.concatenate(([0], np.cumsum(lengths))), np.zeros(len(place), np.int64)
        for size in np.unique(lengths):
            rows = np.flatnonzero(lengths == size)
            places, _, queries = block[size]
            left = queries[np.searchsorted(places, place[rows])]
            right = flat[starts[rows][:, None] + np.arange(size)]
            if max(np.abs(left).max(initial=0), np.abs(right).max(initial=0)) < EXACT:
                out[rows] = (left.astype(np.int64) * right.astype(np.int64)).sum(axis=1)
            else:
                sums = [sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for x, y in zip(left, right, strict=True)]
                out[rows] = [min(max(s, -(2**63)), 2**63 - 1) for s in sums]
        return pa.array(out)

    return F.arrow_udf(of, "bigint")


def _kth(rows, k):
    """Each query's k-th best lower bound, by way of parts of the tasks."""
    for keys in (["place", "part"], ["place"]):
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k).alias("best")
        rows = rows.groupBy(*keys).agg(merged)
    return rows.select("place", F.element_at("best", k).alias("limit"))


def top_k(df, queries, k, id_col="vec_id", vector_col="embedding", query_block=QUERY_BLOCK):
    """(query_id, rank, vec_id, score): the k best of ``df`` for each row of ``queries``."""
    spark = df.sparkSession
    vectors = usable(df, id_col, vector_col).distinct()
    order = Window.partitionBy("v").orderBy("id")
    heads = written(vectors.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1).drop("nth"), "vectors")
    marks = cell_marks(heads)
    approximate = written(heads.select("id", _codes(marks)("v").alias("codes")), "approximations")
    asked = usable(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    asked = written(asked, "queries")
    blocks = max(1, math.ceil(asked.count() / (query_block / 2)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    out = None
    for number in range(blocks):
        rows = asked.filter(F.col("block") == number).orderBy("id").collect()  # about half of query_block
        ids = np.array([r["id"] for r in rows], np.int64)
        shared = spark.sparkContext.broadcast((_block(rows), marks, ids))
        best = approximate.mapInArrow(_best_lower(shared, k), "place bigint, best array<double>")
        best = best.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
        limits = np.full(len(ids), -np.inf)
        for r in _kth(best, k).collect():
            limits[r["place"]] = r["limit"]
        limits = spark.sparkContext.broadcast(limits)
        kind = "query_id bigint, place bigint, id bigint, most double"
        near = written(approximate.mapInArrow(_reaching(shared, limits), kind), "candidates")
        near = near.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("most"), "id")))
        read = lambda some: some.join(heads, "id").select("query_id", "id", _exact(shared)("place", "v").alias("score"))  # noqa: B023, E731
        first = read(near.filter(F.col("nth") <= FIRST * k))
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        certain = first.withColumn("r", F.row_number().over(ranked)).filter(F.col("r") == k).select(F.col("query_id").alias("q"), F.col("score").alias("least"))
        later = near.filter(F.col("nth") > FIRST * k).join(certain, F.col("query_id") == F.col("q")).filter("most >= least")
        found = first.union(read(later)).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        found = written(found.select("query_id", "rank", F.col("id").alias("vec_id"), "score"), "results")
        out = found if out is None else out.union(found)
    return out


def op8_va_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, unnest(e) AS c, unnest(range(0, len(e))) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(sum(q.c * x.c) AS BIGINT) AS score
    FROM x q JOIN x ON q.i = x.i AND q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, x.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
