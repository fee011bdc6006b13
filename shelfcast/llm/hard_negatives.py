"""Hard negatives by angular triangle filtering.

Components become integers, floor(256 x). Every vector stores its norm and its angles to REFERENCES
reference directions; for an anchor at angle a to a direction and a vector at angle b, the angle
between the two is at least |a - b| and at most min(a + b, 2 pi - a - b). The table is written in the
order of (nearest direction, angle to it), so that WINDOW consecutive rows have angles near each
other: their least and largest angles and norms give an interval of cosines for an anchor and all
of the window, and times the norms, rounded away from it, an interval of scores. Only windows whose
interval overlaps the scores an anchor asks for are scored, in integers:

1. positives: scores from the anchor's k-th best one on that the task has seen;
2. negatives: scores from ``low`` to ``high`` percent of one of its positives, and once k are found
   from the k-th best one on.

Each task keeps the k best of each anchor (of each anchor and positive); these are merged in two
steps. Anchors go in blocks of ANCHOR_BLOCK at most (a bounded broadcast), each block reads all rows.
Directions are chosen farthest first among SAMPLE rows with the smallest hashes; they only change how
many windows are scored. Of rows equal in label and vector none beyond the smallest ids can be among
the best (Spark cuts these groups on the map side); anchors are taken from all rows.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
vectors of different lengths are not compared; a row is not compared with rows of its own id;
repeated rows count once, and of an anchor id with several rows the smallest (label, vector) is the
anchor; scores that do not fit 64 bits are cut to their range; anchors without positives, and
positives without negatives, have no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import written
from shelfcast.llm.vectors import lists, matrix, usable

SCALE = 256
REFERENCES = 16
SAMPLE = 1_024
WINDOW = 64
ANCHOR_BLOCK = 8_192
KEEP = 200_000  # candidates that a task holds before it cuts them to the best
SAFE = 1e-6  # radians that an angle is widened by
TOP = 2**63 - 1


def _scaled(c):
    return np.floor(c * SCALE)


def _norms(x):
    return np.sqrt((x * x).sum(axis=1))


def angles(x, directions):
    """Angles of rows to unit directions; a zero row has a right angle to all (its norm bounds it)."""
    norms = _norms(x)
    cosines = (x / np.where(norms > 0, norms, 1)[:, None]) @ directions.T
    return np.arccos(np.clip(cosines, -1, 1))


def directions_of(sample, count=REFERENCES):
    """{length: unit rows}: directions chosen farthest first among the rows of each length."""
    out = {}
    for size in {len(r) for r in sample} - {0}:
        x = np.array([r for r in sample if len(r) == size], float)
        with np.errstate(over="ignore"):
            norms = _norms(x)
        x = x[(norms > 0) & np.isfinite(norms)]
        x = x / _norms(x)[:, None]
        if not len(x):
            continue
        chosen, nearest = [0], x @ x[0]
        while len(chosen) < min(count, len(x)):
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, x @ x[chosen[-1]])
        out[size] = x[chosen]
    return out


def _stored(shared):
    """Struct of the nearest direction, the angles to all and the norm."""

    def run(column):
        _, ends = lists(column)
        sizes = np.diff(ends)
        near, norm = np.zeros(len(column), np.int64), np.zeros(len(column))
        found = [[]] * len(column)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            x = matrix(column, rows, size)
            with np.errstate(over="ignore", invalid="ignore"):
                norm[rows] = _norms(x)
                if size in shared.value:
                    a = np.nan_to_num(angles(x, shared.value[size]), nan=math.pi / 2)
                    near[rows] = a.argmin(axis=1)
                    for place, values in zip(rows, a, strict=True):
                        found[place] = values
        return pa.StructArray.from_arrays([pa.array(near), pa.array(found, pa.list_(pa.float64())), pa.array(norm)], ["near", "angles", "norm"])

    return F.arrow_udf(run, "struct<near: bigint, angles: array<double>, norm: double>")


def score_bounds(a, norm, low, high, least_norm, most_norm):
    """(least, most) score of each anchor (rows) with the vectors of each window (columns).

    a: angles of the anchors; low and high: the windows' least and largest angles.
    """
    gap = np.zeros((len(a), len(low)))
    far = np.full_like(gap, math.pi)
    for r in range(a.shape[1]):
        x = a[:, r, None]
        gap = np.maximum(gap, np.maximum(x - high[None, :, r], low[None, :, r] - x))
        far = np.minimum(far, np.minimum(x + high[None, :, r], 2 * math.pi - x - low[None, :, r]))
    most, least = np.cos(np.maximum(gap - SAFE, 0)), np.cos(np.minimum(far + SAFE, math.pi))
    n = norm[:, None]
    with np.errstate(over="ignore", invalid="ignore"):
        most = most * n * np.where(most > 0, most_norm, least_norm)
        least = least * n * np.where(least > 0, least_norm, most_norm)
        slack = 1 + 1e-9 * (n * most_norm)
        bounds = np.nan_to_num(least - slack, nan=-np.inf), np.nan_to_num(most + slack, nan=np.inf)
    return bounds


def _products(left, right):
    """Exact inner products of integer rows held as doubles, cut to 64 bits."""
    size = left.shape[1]
    most = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(size, 1)
    if most < 2.0**53:
        return (left @ right.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in right]
    out = [[min(max(sum(int(x) * y for x, y in zip(row, other, strict=True)), -TOP - 1), TOP) for other in whole] for row in left]
    return np.array(out, np.int64).reshape(len(left), len(right))


class Block:
    """Anchors of a block: ids, labels, and by length (places, matrix, angles, norms)."""

    def __init__(self, rows, labels, directions):
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.values = pc.unique(labels)
        self.labels = pc.index_in(labels, self.values).to_numpy()
        self.by_size = {}
        for size in {len(r["v"]) for r in rows}:
            places = np.array([i for i, r in enumerate(rows) if len(r["v"]) == size])
            x = np.array([rows[i]["v"] for i in places], float).reshape(len(places), size)
            with np.errstate(over="ignore", invalid="ignore"):
                a = np.nan_to_num(angles(x, directions.get(size, np.zeros((0, size)))), nan=math.pi / 2)
                self.by_size[size] = (places, x, a, _norms(x))

    def windows(self, batch, low, high):
        """Scores of overlapping windows: (places of anchors, ids, label codes, scores).

        low, high: the scores that each anchor asks for, arrays that may change between windows.
        """
        ids, column = batch.column("id").to_numpy(), batch.column("v")
        codes = pc.fill_null(pc.index_in(batch.column("label"), self.values), -1).to_numpy()
        norms, stored = batch.column("norm").to_numpy(), batch.column("angles")
        _, ends = lists(column)
        sizes = np.diff(ends)
        for size in np.unique(sizes):
            if size not in self.by_size:
                continue
            rows = np.flatnonzero(sizes == size)
            places, queries, a, norm = self.by_size[size]
            x, b = matrix(column, rows, size), matrix(stored, rows, a.shape[1])
            starts = np.arange(0, len(rows), WINDOW)
            reduced = lambda f, v: f.reduceat(v, starts, axis=0)
            n = norms[rows]
            least, most = score_bounds(a, norm, reduced(np.minimum, b), reduced(np.maximum, b), reduced(np.minimum, n), reduced(np.maximum, n))
            for w, start in enumerate(starts):
                some = np.flatnonzero((most[:, w] >= low[places]) & (least[:, w] <= high[places]))
                if len(some):
                    part = rows[start : start + WINDOW]
                    yield places[some], ids[part], codes[part], _products(queries[some], x[start : start + WINDOW])


class Best:
    """The k best (score, smaller id first) of each slot."""

    def __init__(self, slots, k):
        self.k, self.limit = k, np.full(slots, -TOP - 1, np.int64)
        self.held, self.size = [], 0

    def add(self, slot, score, ids):
        fits = score >= self.limit[slot]
        if fits.any():
            self.held.append((slot[fits], score[fits], ids[fits]))
            self.size += int(fits.sum())
            if self.size > KEEP:
                self.cut()

    def cut(self):
        if not self.held:
            return (np.zeros(0, np.int64),) * 3
        slot, score, ids = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        order = np.lexsort((ids, ~score, slot))  # ~ turns the order round without an overflow
        slot, score, ids = slot[order], score[order], ids[order]
        nth = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = nth == self.k - 1
        self.limit[slot[last]] = score[last]
        kept = nth < self.k
        self.held, self.size = [(slot[kept], score[kept], ids[kept])], int(kept.sum())
        return self.held[0]

    def batch(self):
        slot, score, ids = self.cut()
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(ids)], ["slot", "score", "id"])


FOUND = "slot bigint, score bigint, id bigint"


def _positives(shared, k):
    def run(batches):
        block = shared.value
        best = Best(len(block.ids), k)
        none = np.full(len(block.ids), np.inf)
        for batch in batches:
            for places, ids, codes, scores in block.windows(batch, best.limit.astype(float), none):
                a, v = np.nonzero((block.labels[places][:, None] == codes[None, :]) & (block.ids[places][:, None] != ids[None, :]))
                best.add(places[a], scores[a, v], ids[v])
            best.cut()
        yield best.batch()

    return run


def _negatives(shared, bounds, k):
    """bounds: (least, most) arrays of anchors x positives; an unused place has most < least."""

    def run(batches):
        block, (least, most) = shared.value, bounds.value
        width = least.shape[1]
        best = Best(least.size, k)
        used = most >= least
        for batch in batches:
            floor = np.maximum(best.limit.reshape(least.shape), least)  # from the k-th best on, once there are k
            low = np.where(used, floor.astype(float), np.inf).min(axis=1, initial=np.inf)
            high = np.where(used, most.astype(float), -np.inf).max(axis=1, initial=-np.inf)
            for places, ids, codes, scores in block.windows(batch, low, high):
                other = (block.labels[places][:, None] != codes[None, :]) & (block.ids[places][:, None] != ids[None, :])
                other &= (scores >= low[places][:, None]) & (scores <= high[places][:, None])
                a, v = np.nonzero(other)
                at, score, own = places[a], scores[a, v], ids[v]
                for p in range(width):
                    fits = (score >= least[at, p]) & (score <= most[at, p])
                    best.add(at[fits] * width + p, score[fits], own[fits])
            best.cut()
        yield best.batch()

    return run


def _merged(rows, k):
    """(slot, best: array of (worse, id) with worse = ~score) of each slot, by way of parts of the tasks."""
    rows = rows.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    rows = rows.select("slot", "part", F.array(F.struct(F.bitwise_not("score").alias("worse"), "id")).alias("best"))
    for keys in (["slot", "part"], ["slot"]):
        rows = rows.groupBy(*keys).agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return rows


def _cut(value):
    return min(max(value, -TOP - 1), TOP)


def mine(df, anchor, positives=5, negatives=5, low=80, high=100, id_col="vec_id", label_col="label", vector_col="embedding", anchor_block=ANCHOR_BLOCK):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on ``id``. Negatives score from low to high percent of the positive.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, _scaled, more=[F.col(label_col).alias("label")]).filter("id IS NOT NULL AND label IS NOT NULL")
    most = max(positives, negatives) + 1
    order = Window.partitionBy("label", "key").orderBy("id")
    heads = rows.distinct().withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth", "key")
    heads = written(heads, "vectors")
    anchors = rows.filter(anchor).drop("key")  # of all rows: a copy that can be nobody's best is an anchor like any other
    sample = heads.orderBy(F.xxhash64("id", "v")).limit(SAMPLE).select("v").collect()
    directions = directions_of([r["v"] for r in sample])
    shared = spark.sparkContext.broadcast(directions)
    table = heads.select("id", "label", "v", _stored(shared)("v").alias("at")).select("id", "label", "v", "at.*")
    to_near = F.coalesce(F.get("angles", F.col("near").cast("int")), F.lit(0.0))
    table = table.withColumn("size", F.size("v")).withColumn("to_near", to_near)
    by = ("size", "near", "to_near", "id")
    stored = written(table.repartitionByRange(*by).sortWithinPartitions(*by).select("id", "label", "v", "angles", "norm"), "angles")
    asked = anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    asked = written(asked.select("id", "row.*"), "anchors")
    blocks = max(1, math.ceil(asked.count() / (anchor_block / 2)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    out = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    for number in range(blocks):
        own = asked.filter(F.col("block") == number).orderBy("id")
        found = own.toArrow()  # about half of anchor_block
        if found.num_rows:
            block = Block(found.select(["id", "v"]).to_pylist(), found.column("label").combine_chunks(), directions)
            out = out.union(written(_mined(spark, stored, block, positives, negatives, low, high), "results"))
    return out


def _mined(spark, stored, block, positives, negatives, low, high):
    shared = spark.sparkContext.broadcast(block)
    best = _merged(stored.mapInArrow(_positives(shared, positives), FOUND), positives).collect()  # k for each anchor of the block
    least = np.full((len(block.ids), positives), TOP, np.int64)
    most = np.full((len(block.ids), positives), -TOP - 1, np.int64)
    slots = []
    for r in best:
        for p, (worse, positive) in enumerate(r["best"]):
            score = ~worse
            least[r["slot"], p], most[r["slot"], p] = _cut(-((-low * score) // 100)), _cut(high * score // 100)
            slots.append((r["slot"] * positives + p, int(block.ids[r["slot"]]), positive, score))
    bounds = spark.sparkContext.broadcast((least, most))
    mined = _merged(stored.mapInArrow(_negatives(shared, bounds, negatives), FOUND), negatives)
    names = spark.createDataFrame(slots, "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    mined = mined.join(names, "slot").select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("at", "one"))
    return mined.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.id").alias("negative_id"),
        "positive_score",
        F.bitwise_not("one.worse").alias("negative_score"),
    )


def op13_hard_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, F.col("id") % 100 == 0)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, label, unnest(e) AS c, unnest(range(0, len(e))) AS i FROM v),
s AS (SELECT q.vec_id AS anchor_id, x.vec_id, any_value(q.label) = any_value(x.label) AS same, CAST(sum(q.c * x.c) AS BIGINT) AS score
    FROM x q JOIN x ON q.i = x.i AND q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0 GROUP BY q.vec_id, x.vec_id),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    WHERE p.r <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
