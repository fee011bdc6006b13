"""Readers for the six tables: fixed schemas, lenient conversion.

CSV files are read as text and Parquet files with their own schema; both are then converted
column by column. Optional columns that a file lacks are left out. Files whose columns have
other names are mapped with ``rename={file column: our column}``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.coerce import (
    as_date,
    as_double,
    as_id,
    as_int,
    as_text,
    keep_existing,
    parse_flag,
    require_columns,
)
from shelfcast.operators.dedup import keep_first
from shelfcast.operators.filters import last_day, only_members, since
from shelfcast.sources.dated import recent_days, stored_days

SALES_COLUMNS = ["date", "store_nbr", "item_nbr", "onpromotion", "unit_sales"]


@dataclass
class RetailTables:
    """The reference tables a feature fit needs."""

    items: DataFrame
    stores: DataFrame
    transactions: DataFrame
    oil: DataFrame
    holidays: DataFrame


def _renamed(df, rename):
    return df.withColumnsRenamed(rename) if rename else df


def _csv(spark, path, rename=None):
    """Every column as text: nothing is inferred, so nothing is read twice."""
    return _renamed(spark.read.option("header", True).csv(path), rename)


def _with(df, **columns):
    """Replaces the given columns, skipping those the table lacks."""
    return df.withColumns({name: make() for name, make in columns.items() if name in df.columns})


def _int_or(df, name, default):
    return lambda: F.coalesce(as_int(df, name), F.lit(default))


def _id(df, name):
    return lambda: F.coalesce(as_id(df, name), F.lit(0).cast("bigint"))


def coerce_sales(df):
    """Undated rows are dropped; missing ids and units become 0, missing promotion false."""
    require_columns(df, ["date"])
    out = _with(
        df,
        date=lambda: as_date(df, "date"),
        store_nbr=_id(df, "store_nbr"),
        item_nbr=_id(df, "item_nbr"),
        unit_sales=lambda: F.coalesce(as_double(F.col("unit_sales")), F.lit(0.0)),
        onpromotion=lambda: parse_flag(df, "onpromotion"),
    )
    return out.filter(F.col("date").isNotNull())


def read_sales(spark, path, weeks=10, columns=None, rename=None, stores=None, items=None):
    """Sales of the trailing ``weeks`` (``None``: all), optionally of some stores and items.

    The file's latest day is found first, so the period filter is a literal and reaches the
    Parquet scan; so do the store and item lists, which are applied to the file's own columns
    (an id of 0 also stands for unreadable ids, so such a list is applied after conversion).
    Of sales stored by day (``write_dated``) the latest day is the name of a folder, and only
    the folders of the period are opened.
    """
    dated = weeks is not None and "date" not in (rename or {}).values()
    days = stored_days(spark, path) if dated else []
    df = _renamed(recent_days(spark, path, days, weeks) if days else spark.read.parquet(path), rename)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*columns)
    latest = None
    if weeks is not None:
        latest = days[-1] if days else last_day(coerce_sales(df))
    for name, wanted in (("store_nbr", stores), ("item_nbr", items)):
        if isinstance(wanted, (list, tuple)) and 0 not in wanted:
            df = only_members(df, name, wanted)
    sales = coerce_sales(df)
    sales = only_members(only_members(sales, "store_nbr", stores), "item_nbr", items)
    return sales if latest is None else since(sales, latest - dt.timedelta(weeks=int(weeks)))


def evaluation_columns(df):
    """The columns evaluation needs, those that exist."""
    return keep_existing(df, SALES_COLUMNS)


def coerce_items(df):
    """One row per item."""
    require_columns(df, ["item_nbr", "family"])
    out = _with(
        df,
        item_nbr=_id(df, "item_nbr"),
        family=lambda: as_text(F.col("family"), "UNKNOWN"),
        perishable=_int_or(df, "perishable", 0),
        **{"class": _int_or(df, "class", -1)},
    )
    return keep_first(out, ["item_nbr"])


def coerce_stores(df):
    """One row per store."""
    require_columns(df, ["store_nbr"])
    out = _with(
        df,
        store_nbr=_id(df, "store_nbr"),
        city=lambda: as_text(F.col("city"), "UNKNOWN"),
        state=lambda: as_text(F.col("state"), "UNKNOWN"),
        type=lambda: as_text(F.col("type"), "UNKNOWN"),
        cluster=_int_or(df, "cluster", -1),
    )
    return keep_first(out, ["store_nbr"])


def coerce_oil(df):
    """Unreadable prices stay null."""
    require_columns(df, ["date", "dcoilwtico"])
    return _with(
        df, date=lambda: as_date(df, "date"), dcoilwtico=lambda: as_double(F.col("dcoilwtico"))
    )


def coerce_transactions(df):
    require_columns(df, ["date", "store_nbr", "transactions"])
    return _with(
        df,
        date=lambda: as_date(df, "date"),
        store_nbr=_id(df, "store_nbr"),
        transactions=lambda: F.coalesce(as_double(F.col("transactions")), F.lit(0.0)),
    )


def coerce_holidays(df):
    require_columns(df, ["date"])

    def text(name):
        return lambda: as_text(F.col(name), "")

    return _with(
        df,
        date=lambda: as_date(df, "date"),
        type=text("type"),
        locale=text("locale"),
        locale_name=text("locale_name"),
        description=text("description"),
        transferred=lambda: parse_flag(df, "transferred"),
    )


def read_items(spark, path, rename=None):
    return coerce_items(_csv(spark, path, rename))


def read_stores(spark, path, rename=None):
    return coerce_stores(_csv(spark, path, rename))


def read_oil(spark, path, rename=None):
    return coerce_oil(_csv(spark, path, rename))


def read_transactions(spark, path, rename=None):
    return coerce_transactions(_csv(spark, path, rename))


def read_holidays(spark, path, rename=None):
    return coerce_holidays(_csv(spark, path, rename))


def read_tables(spark, folder):
    """The five CSV tables under their usual file names."""
    folder = folder.rstrip("/")
    return RetailTables(
        items=read_items(spark, f"{folder}/items.csv"),
        stores=read_stores(spark, f"{folder}/stores.csv"),
        transactions=read_transactions(spark, f"{folder}/transactions.csv"),
        oil=read_oil(spark, f"{folder}/oil.csv"),
        holidays=read_holidays(spark, f"{folder}/holidays_events.csv"),
    )
