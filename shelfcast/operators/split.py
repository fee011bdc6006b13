"""Train / gap / test split back from the latest day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from shelfcast.functions.coerce import as_date, require_columns
from shelfcast.operators.filters import bounds, last_day


@dataclass(frozen=True)
class SplitSizes:
    total: int = 84
    test: int = 14
    gap: int = 3

    @property
    def train(self):
        return self.total - self.test - self.gap


# The smallest test part aimed at, the share of the window that a test part may
# take at most beyond it, and the share of the rest that a gap may take.
LEAST_TEST_DAYS = 7
TEST_SHARE = 6
GAP_SHARE = 10


def fitted_sizes(df, total=84, test=14, gap=3, date_col="date"):
    """One row: the requested sizes shrunk to the days there are, and the latest day.

    At least one day is left to train on; nulls where no row is dated.
    """

    def whole(dividend, divisor):
        return F.floor(dividend / F.lit(divisor)).cast("int")

    days = F.col("n_days")
    row = bounds(df, date_col).withColumn("total", F.when(days.isNotNull(), F.least(F.lit(int(total)), days)))
    row = row.withColumn("test", F.least(F.lit(int(test)), F.greatest(F.lit(LEAST_TEST_DAYS), whole(F.col("total"), TEST_SHARE))))
    room = whole(F.col("total") - F.col("test"), GAP_SHARE)
    row = row.withColumn("gap", F.least(F.lit(int(gap)), F.greatest(F.lit(0), room)))
    short, dated = F.col("total") <= F.col("test"), F.col("total").isNotNull()
    sizes = {
        "test": F.when(short, F.greatest(F.lit(1), F.col("total") - 1)).otherwise(F.col("test")),
        "gap": F.when(short, F.lit(0)).otherwise(F.col("gap")),
    }
    return row.select("total", *[F.when(dated, c).alias(n) for n, c in sizes.items()], F.col("max_date").alias("latest"))


def fit_sizes_to(df, total=84, test=14, gap=3, date_col="date"):
    """(sizes, latest day), from one aggregate over the dates."""
    row = fitted_sizes(df, total, test, gap, date_col).first()
    if row["total"] is None:
        raise ValueError("no dated rows to split")
    return SplitSizes(row["total"], row["test"], row["gap"]), row["latest"]


def _edges(latest, sizes):
    """First day of the whole window, of the gap and of the test part."""
    start = latest - dt.timedelta(days=sizes.total - 1)
    test_start = latest - dt.timedelta(days=sizes.test - 1)
    return start, test_start - dt.timedelta(days=sizes.gap), test_start


def label_split(df, sizes=SplitSizes(), date_col="date", latest=None):
    """Rows of the window with a ``split`` column; older rows are dropped. ``latest`` saves
    looking up the last day when it is known."""
    require_columns(df, [date_col])
    dated = df.withColumn(date_col, as_date(df, date_col))
    latest = latest or last_day(dated, date_col)
    if latest is None:
        return dated.limit(0).withColumn("split", F.lit(None).cast("string"))
    start, gap_start, test_start = _edges(latest, sizes)
    day = F.col(date_col)
    part = (
        F.when(day >= F.lit(test_start), "test").when(day >= F.lit(gap_start), "gap").otherwise("train")
    )
    return dated.filter(day >= F.lit(start)).withColumn("split", part)


def time_split(df, sizes=SplitSizes(), date_col="date", latest=None):
    """(train, gap, test). Each part is a plain date range, so it is pushed into the scan."""
    require_columns(df, [date_col])
    dated = df.withColumn(date_col, as_date(df, date_col))
    latest = latest or last_day(dated, date_col)
    if latest is None:
        raise ValueError("no dated rows to split")
    start, gap_start, test_start = _edges(latest, sizes)
    day = F.col(date_col)
    return (
        dated.filter((day >= F.lit(start)) & (day < F.lit(gap_start))),
        dated.filter((day >= F.lit(gap_start)) & (day < F.lit(test_start))),
        dated.filter(day >= F.lit(test_start)),
    )


def split_info(labelled, date_col="date"):
    """First day, last day and rows of each part, in one pass."""
    return labelled.groupBy("split").agg(
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )
