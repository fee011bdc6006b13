"""Row selection for exploration and evaluation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.functions.coerce import positive

PREVIEW_ROWS = 50
# Longest id list written into the plan as a literal; longer ones become a semi join.
INLINE_IDS = 1000


def as_day(value):
    """A ``date`` from a date, a datetime or ISO text."""
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def bounds(df, date_col="date"):
    """First day, last day and calendar days between them, as a one-row table."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")).withColumn(
        "n_days", F.datediff("max_date", "min_date") + 1
    )


def last_day(df, date_col="date"):
    """The latest day as a plain value: used as a literal it is pushed into the file scan."""
    return df.agg(F.max(date_col)).first()[0]


def since(df, start, date_col="date"):
    return df.filter(F.col(date_col) >= F.lit(start))


def trailing_weeks(df, weeks, date_col="date"):
    """Last ``weeks`` weeks, both ends included: 10 weeks keep 71 days."""
    latest = last_day(df, date_col)
    return df.limit(0) if latest is None else since(df, latest - dt.timedelta(weeks=int(weeks)), date_col)


def trailing_days(df, days, date_col="date"):
    """Exactly the last ``days`` calendar days."""
    latest = last_day(df, date_col)
    return df.limit(0) if latest is None else since(df, latest - dt.timedelta(days=int(days) - 1), date_col)


def between_dates(df, start, end, date_col="date"):
    """Inclusive on both ends; reversed ends are swapped."""
    low, high = sorted([as_day(start), as_day(end)])
    return df.filter(F.col(date_col).between(F.lit(low), F.lit(high)))


def only_members(df, column, wanted):
    """Rows whose ``column`` is in ``wanted``: a list, or a one-column table of ids.

    An empty list or ``None`` means no filter.
    """
    if wanted is None:
        return df
    if not hasattr(wanted, "columns"):
        wanted = list(wanted)
        if not wanted:
            return df
        if len(wanted) <= INLINE_IDS:
            return df.filter(F.col(column).isin(wanted))
        wanted = df.sparkSession.createDataFrame([(w,) for w in wanted], [column])
    ids = wanted.toDF(column).withColumn(column, F.col(column).cast(df.schema[column].dataType))
    return df.join(ids, column, "left_semi")


def select_sales(df, start, end, stores=None, items=None):
    """The dashboard filter: period, then optional stores and items, plus positive units."""
    kept = only_members(between_dates(df, start, end), "store_nbr", stores)
    kept = only_members(kept, "item_nbr", items)
    return kept.withColumn("unit_sales_pos", positive(F.col("unit_sales")))


def distinct_ids(df, column):
    """The ids that occur, in order: a picker's list."""
    return _ids(df, column).orderBy(column)


def _ids(df, column):
    return df.filter(F.col(column).isNotNull()).select(column).distinct()


def search_ids(df, column, text="", limit=None):
    """Ids containing ``text``, smallest first; a page of ``limit`` of them if one is asked for."""
    ids = _ids(df, column)
    text = text.strip()
    if text:
        ids = ids.filter(F.col(column).cast("string").contains(text))
    ids = ids.orderBy(column)
    return ids if limit is None else ids.limit(int(limit))


def preview(df, order, rows=PREVIEW_ROWS):
    return df.orderBy(*order).limit(int(rows))
