"""Left joins onto lookup tables with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
_WIDTH = {T.StringType: 64}


def row_bytes(schema):
    """Rough size of a row of the (fixed-width, mostly) lookup tables."""
    return 16 + sum(_WIDTH.get(type(f.dataType), 8) for f in schema.fields)


def small_enough(table, n_rows, limit=BROADCAST_BYTES):
    return n_rows * row_bytes(table.schema) <= limit


def merge(keys, *tables):
    """One lookup table from several that are each unique on ``keys``: stacked and collapsed
    in a single shuffle, where a chain of full joins would need one per table."""
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def lookup(rows, table, keys, n_rows=None, limit=BROADCAST_BYTES):
    """``rows`` with the columns of ``table`` (unique on ``keys``), null where absent.

    ``n_rows`` is the counted size of ``table``. It is broadcast only when that many rows
    stay under ``limit``; otherwise this is an ordinary shuffled join, where adaptive
    execution splits a hot key on the row side (the table side has one row per key).
    """
    if n_rows is not None and small_enough(table, n_rows, limit):
        table = F.broadcast(table)
    return rows.join(table, keys, "left")
