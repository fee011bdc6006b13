"""One row per key.

Spark tables have no row order, so "first" and "last" follow the given order columns; the
remaining columns break ties. Written as a max/min aggregate rather than a ranking window:
the map side already reduces each key to one row, so a key holding a third of the table
never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F


def _one_per_key(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys and c not in order]
    order = [c for c in order if c not in keys]
    if not order + rest:
        return df.distinct()
    if len(order + rest) == 1:
        # A single plain value needs no struct, and Spark can hash instead of sort.
        value = (order + rest)[0]
        return df.groupBy(*keys).agg(pick(value).alias(value)).select(*df.columns)
    chosen = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return chosen.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_last(df, keys, order=()):
    return _one_per_key(df, list(keys), list(order), F.max)


def keep_first(df, keys, order=()):
    return _one_per_key(df, list(keys), list(order), F.min)
