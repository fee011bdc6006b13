"""A repeatable random sample of an exact size."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16


def _cut(hist, room):
    """(buckets below this one are kept whole, rows still missing after them)."""
    for bucket, n in sorted(hist):
        if n > room:
            return bucket, room
        room -= n
    return BUCKETS, 0


def _histogram(df, column):
    """Rows per bucket: at most 65,536 numbers, whatever the table holds."""
    return [(r[0], r[1]) for r in df.groupBy(column).agg(F.count(F.lit(1))).collect()]


def exact_sample(df, rows, seed=42):
    """Exactly ``rows`` rows (all of them if there are no more), the same ones every time.

    Rows are ranked by a seeded hash of their content and the smallest hashes win. A sort
    with a limit would send ``rows`` candidates per partition to one task; here two
    histograms of 16 hash bits each find the cut, and everything below it is kept by a plain
    filter. Only the rows sharing all 32 bits with the cut are ranked one by one, after equal
    rows are collapsed into a count, so copies cannot pile up in one task either.
    """
    cols = df.columns
    content = [c for name in cols for c in (F.col(name), F.col(name).isNull())]
    h = F.xxhash64(*content, F.lit(int(seed)))
    ranked = df.withColumns(
        {
            "_hi": F.shiftrightunsigned(h, 48).cast("int"),
            "_lo": F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"),
            "_h": h,
        }
    )
    high, room = _cut(_histogram(ranked, "_hi"), int(rows))
    if high == BUCKETS:
        return df
    kept = F.col("_hi") < high
    edge = ranked.filter(F.col("_hi") == high)
    low, room = _cut(_histogram(edge, "_lo"), room)
    kept = kept | ((F.col("_hi") == high) & (F.col("_lo") < low))
    whole = ranked.filter(kept).select(*cols)
    if room == 0:
        return whole
    copies = edge.filter(F.col("_lo") == low).groupBy(*cols, "_h").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy("_h", *cols).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(order), F.lit(0))
    taken = F.least(F.col("_n"), F.lit(room) - F.col("_before")).cast("int")
    rest = (
        copies.withColumn("_before", before)
        .filter(F.col("_before") < room)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), taken)))
        .select(*cols)
    )
    return whole.unionByName(rest)
