"""Dashboard tables: KPIs, daily series, top groups, promotion split, week heatmap.

Every function is one grouped aggregate with map-side combining. ``mode`` is "count" (rows)
or "units" (sum of ``y_col``). Null group keys are dropped.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.functions.coerce import parse_flag, positive, require_columns, sales_column

# Labels shown by the reports.
PROMO_LABELS = {False: "Sans promo", True: "Avec promo"}
WEEKDAY_LABELS = ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
NO_PERIOD = "—"
PERIOD_ARROW = " → "

SERIES_KEYS = {
    "pair": ["store_nbr", "item_nbr"],
    "item": ["item_nbr"],
    "store": ["store_nbr"],
}


def _measure(df, mode, y_col, clip=True):
    """(output name, row value, aggregate) of a mode."""
    if mode == "count":
        return "n_obs", F.lit(1).cast("bigint")
    if mode != "units":
        raise ValueError(f"mode must be 'count' or 'units', not {mode!r}")
    name = sales_column(df, y_col)
    return name, positive(F.col(name)) if clip else F.col(name)


def _total(value):
    """Sum in which a group of nothing but nulls gives 0."""
    return F.coalesce(F.sum(value), F.lit(0))


def _present(df, *keys):
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _grouped(df, keys, mode, y_col, clip=True):
    require_columns(df, keys)
    name, value = _measure(df, mode, y_col, clip)
    return _present(df, *keys).groupBy(*keys).agg(_total(value).alias(name)), name


def active_counts(df):
    """Stores and items with at least one row (exact)."""
    return df.agg(
        F.count_distinct("store_nbr").alias("n_stores"),
        F.count_distinct("item_nbr").alias("n_items"),
    )


def kpi(df, mode="count", date_col="date", sales_col="unit_sales_pos"):
    """One typed row: period, stores, items, total, mean per observed day.

    No rows give the period "—" and nulls. A single scan; Spark expands the distinct counts
    and reduces each to its distinct keys on the map side.
    """
    name, value = _measure(df, mode, sales_col)

    def distinct(column):
        return F.count_distinct(column) if column in df.columns else F.lit(0).cast("bigint")

    row = _present(df, date_col).agg(
        F.min(date_col).alias("lo"),
        F.max(date_col).alias("hi"),
        distinct("store_nbr").alias("n_stores"),
        distinct("item_nbr").alias("n_items"),
        F.count_distinct(date_col).alias("n_days"),
        F.sum(value).alias("total"),
    )
    seen = F.col("n_days") > 0
    period = F.concat(F.col("lo").cast("string"), F.lit(PERIOD_ARROW), F.col("hi").cast("string"))
    return row.select(
        F.coalesce(period, F.lit(NO_PERIOD)).alias("period"),
        F.when(seen, F.col("n_stores")).alias("n_stores"),
        F.when(seen, F.col("n_items")).alias("n_items"),
        F.col("total"),
        S.ratio(F.col("total"), F.col("n_days"), empty=None).alias("mean_per_day"),
    )


def daily_sales(df, mode="count", y_col="unit_sales", date_col="date", clip=True):
    """Rows or units per day, in order. ``clip=False`` sums the column as it is."""
    return _per_day(df, mode, y_col, date_col, clip).orderBy(date_col)


def _per_day(df, mode, y_col, date_col, clip=True):
    return _grouped(df, [date_col], mode, y_col, clip)[0]


def daily_by_series(df, key_mode="pair", y_col="unit_sales_pos"):
    """Long table date, series, value, in order. Grouped on the ids; the label is built
    afterwards, on the reduced rows."""
    return _by_series(df, key_mode, y_col).orderBy("date", "series")


def _by_series(df, key_mode, y_col):
    keys = SERIES_KEYS[key_mode]
    totals, name = _grouped(df, ["date", *keys], "units", y_col, clip=False)
    return totals.select(
        "date", S.series_label(*[F.col(k) for k in keys]).alias("series"), F.col(name).alias("value")
    )


def daily_wide(df, key_mode="pair", y_col="unit_sales_pos", *, series):
    """One column per series, in order of days; null where a series has no sales that day.

    The columns are the caller's selection: a table's columns are not read from its data. Spark
    limits their number (``spark.sql.pivotMaxValues``); ``daily_by_series`` has no limit.
    """
    long = _by_series(df, key_mode, y_col)
    return long.groupBy("date").pivot("series", list(series)).agg(F.sum("value")).orderBy("date")


def daily_by_group(df, group_col, y_col="unit_sales_pos", date_col="date"):
    return _grouped(df, [date_col, group_col], "units", y_col, clip=False)[0]


def top_groups(df, group_col, n=10, mode="count", y_col="unit_sales", ascending=False, clip=True):
    """The ``n`` largest (or smallest) groups; equal totals are ordered by group."""
    totals, name = _grouped(df, [group_col], mode, y_col, clip)
    first = F.col(name).asc() if ascending else F.col(name).desc()
    return totals.orderBy(first, group_col).limit(int(n))


def _leaders(df, group_col, n, y_col):
    """The ``n`` largest groups by summed units. How they are joined is left to adaptive execution,
    which knows their size."""
    return top_groups(df, group_col, n, "units", y_col, clip=False).select(group_col)


def rows_of_top_groups(df, group_col, n=8, y_col="unit_sales_pos"):
    """Rows belonging to the ``n`` groups with the largest totals."""
    return df.join(_leaders(df, group_col, n, y_col), group_col, "left_semi")


def daily_of_top_groups(df, group_col, n=8, y_col="unit_sales_pos", date_col="date"):
    """Daily units of the ``n`` largest groups.

    Totals and series come from the same per-day table. The join is an inner one on purpose:
    a semi join would be pushed below the per-day aggregate, and the sales would be read and
    shuffled twice instead of once.
    """
    daily = daily_by_group(df, group_col, y_col, date_col)
    return daily.join(_leaders(daily, group_col, n, sales_column(daily, y_col)), group_col)


def sales_with_family(sales, items):
    """Sales rows with the item's family; null where the item is unknown."""
    return sales.join(items.select("item_nbr", "family"), "item_nbr", "left")


def top_families(sales, items, n=10, mode="units", y_col="unit_sales_pos", clip=True):
    """Largest families. Sales are first reduced to one row per item, so the join moves items
    rather than sales rows and a best-selling item cannot skew it. Items missing from the
    items table have no family and are left out."""
    per_item, name = _grouped(sales, ["item_nbr"], mode, y_col, clip)
    totals = per_item.join(items.select("item_nbr", "family"), "item_nbr")
    return (
        _present(totals, "family")
        .groupBy("family")
        .agg(_total(F.col(name)).alias(name))
        .orderBy(F.col(name).desc(), "family")
        .limit(int(n))
    )


def promo_split(df, mode="count", promo_col="onpromotion", y_col="unit_sales"):
    """Rows or units with and without promotion."""
    if promo_col not in df.columns:
        promo_col = "onpromo"
        require_columns(df, [promo_col])
    name, value = _measure(df, mode, y_col)
    label = F.when(parse_flag(df, promo_col), PROMO_LABELS[True]).otherwise(PROMO_LABELS[False])
    return df.groupBy(label.alias("promo")).agg(_total(value).alias(name))


def week_heatmap(df, mode="count", y_col="unit_sales", date_col="date"):
    """ISO week by weekday, in order of weeks, empty cells 0."""
    name, _ = _measure(df, mode, y_col)
    day = F.col(date_col)
    per_day = _per_day(df, mode, y_col, date_col)
    empty = F.lit(0).cast(per_day.schema[name].dataType)
    cells = [
        F.sum(F.when(S.weekday(day) == i, F.col(name)).otherwise(empty)).alias(label)
        for i, label in enumerate(WEEKDAY_LABELS)
    ]
    weeks = per_day.groupBy(S.iso_year(day).alias("iso_year"), S.iso_week(day).alias("iso_week")).agg(*cells)
    weeks = weeks.withColumn("week_label", S.week_label(F.col("iso_year"), F.col("iso_week")))
    return weeks.orderBy("iso_year", "iso_week")
