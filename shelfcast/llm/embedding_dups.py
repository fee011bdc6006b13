"""Embedding near-duplicates by PCA-ordered tiled comparison. All rows are compared, exactly.

1. Equal vectors are one class with its number of rows. Vectors are turned into the principal axes
   of all unit vectors (eigenvectors of their second moments, summed by Spark), the axis of most
   variance first; a turn keeps inner products.
2. Classes are put in order by their leading components: quantiles of the first axis, and of the
   second within these, cut them into groups (MOST_GROUPS at most, about BLOCK classes each or
   more), and a hash cuts large groups into blocks of about BLOCK. Two groups whose boxes of leading
   components, with the products of their suffix norms, cannot reach the threshold never meet.
3. Each pair of blocks that may reach it is a unit of work of at most about 2 * BLOCK classes. In it,
   tiles of TILE rows are compared: the products of the first STEPS[0] components plus the products
   of the suffix norms bound the cosines from above (one matrix product, the suffix norm as one more
   column); what cannot reach the threshold stops there, the rest accumulates the next components
   with the next suffix norms, and so on. Cosines within NEAR of the threshold are computed anew from
   the given vectors.
4. A unit returns, for each linked class, its number of linked rows and one representative of its
   part of the component, so links are counted, not listed: copies by the thousand take rows in
   proportion to their number. The representatives' links go to ``components``.

Defined cases: null or zero vectors and those with null or non-finite components link with nothing;
vectors of different lengths do not link; each row is a vector of its own, also where ids or whole
rows repeat (n_links counts the other rows); null ids take part, the component's id is the smallest
that is not null, and a row is kept if its id is the component's, null for null. Rows come back
whatever their vector is. An empty table has no rows. Two cosines that round to different sides of
the threshold in different orders of summation (by 1e-16) are decided by numpy's.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.tables import written
from shelfcast.llm.vectors import finite, lists, matrix, usable

THRESHOLD = 0.9
BLOCK = 16_384
MOST_GROUPS = 256
LEADING = 8  # components in a group's box
TILE = 512
STEPS = (16, 32)
NEAR = 1e-9
DENSE = 0.1  # share of a tile's pairs from which the next components are multiplied for all of them
LINKED = "key binary, links bigint, root binary"


def _scaled(x):
    """Rows times powers of two (which is exact), so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit_rows(x):
    """Rows of length 1."""
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_size(column):
    """(size, places) of an Arrow column of lists."""
    _, ends = lists(column)
    sizes = np.diff(ends)
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


def _moments(batches):
    sums = {}
    for batch in batches:
        for size, rows in _by_size(batch.column(0)):
            u = unit_rows(matrix(batch.column(0), rows, size))
            sums[size] = sums.get(size, 0) + u.T @ u
    for size, m in sums.items():
        row, column = np.indices((size, size)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size * size, size)), pa.array(row), pa.array(column), pa.array(m.ravel())], ["size", "a", "b", "m"])


def rotations(classes):
    """{size: d x d matrix of principal axes as columns, the strongest first}."""
    sums = classes.select("v").mapInArrow(_moments, "size bigint, a bigint, b bigint, m double")
    out = {}
    for r in sums.groupBy("size", "a", "b").agg(F.sum("m").alias("m")).collect():
        out.setdefault(r["size"], np.zeros((r["size"], r["size"])))[r["a"], r["b"]] = r["m"]
    return {size: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for size, m in out.items()}


def _leading(shared):
    """Struct of the LEADING components on the axes, and the norm of what is left."""

    def run(column):
        lead, rest = np.zeros((len(column), LEADING)), np.zeros(len(column))
        for size, rows in _by_size(column):
            w = unit_rows(matrix(column, rows, size)) @ shared.value[size]
            lead[rows, : min(size, LEADING)] = w[:, :LEADING]
            rest[rows] = np.sqrt((w[:, LEADING:] ** 2).sum(axis=1))
        parts = pa.ListArray.from_arrays(pa.array(np.arange(0, lead.size + 1, LEADING), pa.int32()), pa.array(lead.ravel()))
        return pa.StructArray.from_arrays([parts, pa.array(rest)], ["lead", "rest"])

    return F.arrow_udf(run, "struct<lead: array<double>, rest: double>")


def _grouped(classes, most):
    """The table with a column ``group``: quantiles of the first axis, then of the second, per length."""
    spark = classes.sparkSession
    sizes = {r["size"]: r["n"] for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    out, wanted = classes.withColumn("group", F.lit(0)), min(most, sum(math.ceil(n / BLOCK) for n in sizes.values()))
    across = max(1, round(math.sqrt(wanted)))
    for axis, parts in enumerate((across, math.ceil(wanted / across))):
        steps = [i / parts for i in range(1, parts)]
        if not steps:
            continue
        cuts = out.groupBy("size", "group").agg(F.percentile_approx(F.col("lead")[axis], F.array(*map(F.lit, steps)), 10_000).alias("cuts"))
        cuts = spark.createDataFrame([tuple(r) for r in cuts.collect()], "size int, group int, cuts array<double>")  # a row per group
        place = F.size(F.filter("cuts", lambda c: c <= F.col("lead")[axis]))
        out = out.join(F.broadcast(cuts), ["size", "group"]).withColumn("group", F.col("group") * parts + place).drop("cuts")
    return out


def _meetings(groups, threshold):
    """(size, group, first block, blocks, partners) of each group; partners are (first block, blocks) of groups that may reach it."""
    blocks = [max(1, math.ceil(g["n"] / BLOCK)) for g in groups]
    first = np.concatenate(([0], np.cumsum(blocks)))
    low, high = (np.array([g[k] for g in groups]).reshape(len(groups), LEADING) for k in ("low", "high"))
    rest = np.array([g["rest"] for g in groups])
    size = np.array([g["size"] for g in groups])
    bound = rest[:, None] * rest[None, :]
    for i in range(low.shape[1]):
        corners = [a[:, i, None] * b[None, :, i] for a in (low, high) for b in (low, high)]
        bound = bound + np.maximum.reduce(corners)
    meet = (bound >= threshold - NEAR) & (size[:, None] == size[None, :])
    return [(g["size"], g["group"], int(first[i]), blocks[i], [(int(first[j]), blocks[j]) for j in np.flatnonzero(meet[i])]) for i, g in enumerate(groups)]


def cosines(x, a, b):
    """Cosines of rows ``a`` with rows ``b`` of the given vectors, in double precision."""
    x, y = _scaled(x[a]), _scaled(x[b])
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


class Tiles:
    """Compares the rows of a unit: their vectors, and these on the axes with the norms of the suffixes."""

    def __init__(self, x, axes, threshold):
        self.x, self.w, self.threshold = x, unit_rows(x) @ axes, threshold
        size = x.shape[1]
        self.ends = [*[s for s in STEPS if s < size], size]
        self.suffix = [np.sqrt((self.w[:, e:] ** 2).sum(axis=1)) for e in self.ends]
        self.bounded = np.concatenate((self.w[:, : self.ends[0]], self.suffix[0][:, None]), axis=1)
        self.steps = [0, 0]  # pairs bounded by the first components, pairs that went further

    def links(self, a, b):
        """Pairs (row of ``a``, row of ``b``) that reach the threshold; a and b are ranges of rows."""
        least = self.threshold - NEAR
        bound = self.bounded[a.start : a.stop] @ self.bounded[b.start : b.stop].T
        left, right = np.nonzero(bound >= least)
        self.steps[0] += bound.size
        self.steps[1] += len(left)
        dense = len(left) > DENSE * bound.size
        left, right = left + a.start, right + b.start
        done, so_far = self.ends[0], None
        for end, rest in zip(self.ends[1:], self.suffix[1:], strict=True):
            if not len(left):
                return left, right
            if dense:  # many go on: multiply the next components for the whole tile
                part = (self.w[a.start : a.stop, :end] @ self.w[b.start : b.stop, :end].T)[left - a.start, right - b.start]
            else:
                part = np.einsum("ij,ij->i", self.w[left, done:end], self.w[right, done:end])
                part += so_far if so_far is not None else np.einsum("ij,ij->i", self.w[left, :done], self.w[right, :done])
            reach = part + rest[left] * rest[right] >= least
            left, right, so_far, done = left[reach], right[reach], part[reach], end
        if so_far is None:
            so_far = np.einsum("ij,ij->i", self.w[left], self.w[right])
        fits = so_far >= self.threshold + NEAR
        unsure = np.flatnonzero(~fits)
        fits[unsure] = cosines(self.x, left[unsure], right[unsure]) >= self.threshold
        return left[fits], right[fits]


def _hook(root, a, b):
    """Joins the parts of linked rows; ``root`` points each row at the smallest row of its part."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart]))
        while (root[root] != root).any():
            root = root[root]


def compare(x, axes, cuts, copies, threshold):
    """(links of each row, root of each row, the tiles). ``cuts``: rows before it meet rows from it on; None: all meet all."""
    tiles, n = Tiles(x, axes, threshold), len(x)
    links, root = np.zeros(n, np.int64), np.arange(n)
    ranges = lambda lo, hi: [range(s, min(s + TILE, hi)) for s in range(lo, hi, TILE)]
    rows = ranges(0, n if cuts is None else cuts)
    for i, a in enumerate(rows):
        for b in rows[i:] if cuts is None else ranges(cuts, n):
            left, right = tiles.links(a, b)
            if a is b:
                once = left < right
                left, right = left[once], right[once]
            if len(left):
                links += np.bincount(left, copies[right], n).astype(np.int64) + np.bincount(right, copies[left], n).astype(np.int64)
                root = _hook(root, left, right)
    return links, root, tiles


def _unit(shared, threshold):
    def run(table):
        block = table.column("block").to_numpy()
        first = table.column("a")[0].as_py()
        rest = np.flatnonzero(block != first)
        order = np.concatenate((np.flatnonzero(block == first), rest))
        table = table.take(order).combine_chunks()
        column = table.column("v")
        size = len(column[0])
        x = matrix(column, np.arange(len(column)), size)
        cuts = None if table.column("b")[0].as_py() == first else len(order) - len(rest)
        links, root, _ = compare(x, shared.value[size], cuts, table.column("copies").to_numpy().astype(float), threshold)
        found, keys = np.flatnonzero(links), table.column("key")
        return pa.table([keys.take(found), pa.array(links[found]), keys.take(root[found])], ["key", "links", "root"])

    return run


def linked_classes(classes, threshold):
    """(key, links, root) of classes with links, one row for each unit in which they have some."""
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(rotations(classes))
    lead = _leading(shared)(F.col("v").cast("array<double>"))
    placed = written(_grouped(classes.withColumn("at", lead).select("*", "at.lead", "at.rest").drop("at"), MOST_GROUPS), "groups")
    ends = [f(F.col("lead")[i]) for f in (F.min, F.max) for i in range(LEADING)]
    stats = placed.groupBy("size", "group").agg(
        F.count("*").alias("n"), F.max("rest").alias("rest"), F.array(*ends[:LEADING]).alias("low"), F.array(*ends[LEADING:]).alias("high")
    )
    table = spark.createDataFrame(
        _meetings(stats.collect(), threshold), "size int, group int, first int, blocks int, partners array<struct<first: int, blocks: int>>"
    )
    # at most MOST_GROUPS rows (and one for each further length) of as many partners
    rows = placed.select("key", "copies", "v", "size", "group").join(F.broadcast(table), ["size", "group"])
    own = F.col("first") + F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    others = F.flatten(F.transform("partners", lambda p: F.sequence(p["first"], p["first"] + p["blocks"] - 1)))
    rows = rows.withColumn("block", own).withColumn("with", F.explode(others))
    rows = rows.select(F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "block", "key", "copies", "v")
    return rows.groupBy("a", "b").applyInArrow(_unit(shared, threshold), LINKED)


def near_duplicates(df, threshold=THRESHOLD, id_col="vec_id", vector_col="embedding"):
    """(id, n_links, component_id, kept), a row for each row of ``df``."""
    kind = "array<float>" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    nonzero = F.exists("v", lambda x: x != 0)
    some = usable(df, id_col, vector_col).withColumn("nonzero", nonzero)
    rows = written(some.withColumn("v", F.col("v").cast(kind)), "vectors")
    classes = rows.filter("nonzero").groupBy("key").agg(F.any_value("v").alias("v"), F.count("*").alias("copies"), F.min("id").alias("first_id"))
    classes = written(classes.withColumn("size", F.size("v")), "classes")
    linked = written(linked_classes(classes, threshold), "linked")
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    found = classes.select("key", "copies", "first_id").join(counts, "key", "left")
    found = found.join(roots.withColumnRenamed("id", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    firsts = found.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = found.join(firsts, "root").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = rows.filter("nonzero").select("id", "key").join(found, "key").select("id", "n_links", "component_id")
    alone = lambda some: some.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    unusable = unusable_ids(df, id_col, vector_col)
    out = joined.unionByName(alone(rows.filter("NOT nonzero"))).unionByName(alone(unusable))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def unusable_ids(df, id_col, vector_col):
    """Ids of rows without a usable vector."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    return rows.filter(F.col("x").isNull() | ~finite("x")).select("id")


def op12_embedding_dups(spark, sf_dir):
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return found.withColumnRenamed("id", "vec_id")


OP12_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
    AND list_dot_product(p.e, q.e) / sqrt(list_dot_product(p.e, p.e) * list_dot_product(q.e, q.e)) >= 0.9),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS least_b FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.least_b, e.vec_id)) AS component_id,
    e.vec_id = least(e.vec_id, coalesce(c.least_b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""
