"""Mixing sources to target weights.

Every document gets a hash-random key, made of its id and its text. Within a source, documents are
range-sorted by that key: the key range is cut into equal slices (the keys are uniform, so the
slices are even, also within a source or under an id that holds most rows), each slice is summed on
its own, the slice totals become distributed prefix sums, and the source is cut at its exact budget.
A budget above the source's size takes the source whole, as often as it fits, and cuts the next
epoch. Whole rows move once: the prefix sums and the join of the slices' totals share a partitioning.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is a source of
its own, after all others; rows equal in id and text have one key and are ordered by a hash of their
other columns (but for maps, which have no hash), so a mix of the same rows is the same rows however
they are partitioned; rows that tie in that, too, are interchangeable, and lie in one slice; an empty
table gives an empty mix; a column of the input with the name of an added one is replaced. Sources
are ranked and given targets on one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import documents, own_name, without
from shelfcast.llm.textops import WORD_RE

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SLICE_ROWS = 2_000
ADDED = ("size", "source_size", "target", "taken")


def word_count(text):
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes, source, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS):
    """Each source's size and target, from a table of (source, size).

    Targets are min(most * size, level * weight) with one level for all sources: what resharing
    the excess by weight until none is above its cap comes to. In the order of cap / weight the
    capped sources are a prefix, and the level is what is left over the weights that are left.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = sizes.groupBy(source).agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    table = table.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    table = table.withColumn("place", F.row_number().over(Window.orderBy(F.col("cap") / F.col("weight"), F.col(source).asc_nulls_last())))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    table = table.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / left)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    table = table.withColumn("cut", F.min(fits).over(everything))
    capped = F.col("cut").isNull() | (F.col("place") < F.col("cut.place"))
    target = F.when(capped, F.col("cap")).otherwise(F.least(F.col("cut.level") * F.col("weight"), F.col("cap")))
    return table.select(source, "source_size", target.alias("target"))


def mix(df, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS):
    """The table with size, source_size, target and taken: words that the mix takes, with repeats.

    The words taken of a source add up to its target, rounded down.
    """
    df = without(df, *ADDED)
    key, part, run, of, base, tie = (own_name(df, n) for n in ("mix_key", "mix_slice", "mix_run", "mix_source", "mix_base", "mix_tie"))
    text, source = F.col(text_col), F.col(source_col).cast("string")
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(" "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    rows = df.withColumn("size", word_count(text)).withColumn(key, digest).withColumn(part, F.substring(key, 1, _slice_digits(df)))
    rows = rows.withColumn(of, F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)))  # never null, so that it joins as it partitions
    totals = rows.groupBy(of, part).agg(F.sum("size").alias("size"))
    named = F.when(F.col(of) != "", F.substring(of, 2, 2**31 - 1)).alias("to")
    targets = source_targets(totals.select(named, "size"), "to", weights, share, most)
    targets = targets.withColumn("to", F.when(F.col("to").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "to"))).withColumnRenamed("to", of)
    earlier = Window.partitionBy(of).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    plan = totals.withColumn(base, F.coalesce(F.sum("size").over(earlier), F.lit(0))).drop("size").join(targets, of)
    others = [c for c, kind in df.dtypes if c not in (id_col, text_col, source_col) and "map<" not in kind and kind != "variant"]
    rows = rows.withColumn(tie, F.xxhash64(*others) if others else F.lit(0).cast("long"))
    within = Window.partitionBy(of, part).orderBy(key, "size", tie).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(run, F.coalesce(F.sum("size").over(within), F.lit(0))).join(plan, [of, part])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col(base) - F.col(run)
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return rows.withColumn("taken", (epochs * F.col("size") + cut).cast("long")).select(*df.columns, *ADDED)


def _slice_digits(df):
    """Hexadecimal digits of the key that give slices of about SLICE_ROWS rows, 65,536 slices at most."""
    return min(4, max(1, math.ceil(math.log(max(1.0, df.count() / SLICE_ROWS), 16))))


def materialise(mixed, text_col="text"):
    """The mix as rows: one copy of a document for each epoch, the last cut after its taken words."""
    columns = [c for c in mixed.columns if c not in ADDED]
    at = own_name(mixed, "mix_epoch")
    epochs = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    rows = mixed.filter("taken > 0").withColumn(at, F.explode(epochs))
    left = F.col("taken") - (F.col(at) - 1) * F.col("size")
    words = F.split(text_col, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each with the space before it
    cut = F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")
    return rows.withColumn(text_col, F.when(left >= F.col("size"), F.col(text_col)).otherwise(cut)).select(*columns)


def op10_source_mix(spark, sf_dir):
    return mix(documents(spark, sf_dir).select("doc_id", "text", "source")).select("doc_id", *ADDED)


#: The same, level by level: the level is the largest that fits when the k lowest caps are taken.
OP10_SQL = """
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
    source_size * 2.0::DOUBLE AS cap FROM r),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS lv,
    row_number() OVER (ORDER BY cap / w, i) AS o FROM w),
c AS (SELECT arg_min(lv, o) AS lv, min(o) AS o FROM l WHERE lv * w <= cap),
t AS (SELECT l.source, l.source_size, CASE WHEN c.o IS NULL OR l.o < c.o THEN l.cap ELSE least(c.lv * l.w, l.cap) END AS target FROM l CROSS JOIN c),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target) AS b,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(b / source_size) ELSE 0 END AS n FROM p)
SELECT doc_id, size, source_size, target,
    CAST(n * size + greatest(0, least(size, b - n * source_size - before)) AS BIGINT) AS taken FROM e
"""
