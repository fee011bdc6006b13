"""Effective holidays per day and per (day, store)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.coerce import as_text, parse_flag

TEXT_COLUMNS = ["type", "locale", "locale_name", "description"]


def normalise(holidays):
    """Absent columns are created; text is trimmed; ``transferred`` becomes a flag."""
    for name in [*TEXT_COLUMNS, "transferred"]:
        if name not in holidays.columns:
            holidays = holidays.withColumn(name, F.lit(None).cast("string"))
    return holidays.select(
        "date",
        *[as_text(F.col(c), "").alias(c) for c in TEXT_COLUMNS],
        parse_flag(holidays, "transferred").alias("transferred"),
    )


def observed(holidays):
    """Adds ``event_key``, ``observed_date`` and ``f_holiday``.

    A transferred holiday is observed on the earliest Transfer day with the same description,
    locale and place; without such a day it stays on its own date.
    """
    rows = normalise(holidays).withColumn(
        "event_key", F.concat_ws(" | ", "description", "locale", "locale_name")
    )
    moves = (
        rows.filter("type = 'Transfer'").groupBy("event_key").agg(F.min("date").alias("moved_to"))
    )
    is_holiday = F.col("type") == "Holiday"
    moved = F.when(is_holiday & F.col("transferred"), F.col("moved_to"))
    return rows.join(moves, "event_key", "left").select(
        *rows.columns,
        F.coalesce(moved, F.col("date")).alias("observed_date"),
        is_holiday.cast("int").alias("f_holiday"),
    )


def _by_place(observed_rows, locale):
    """One row per (observed day, place) of a locale."""
    return (
        observed_rows.filter((F.col("locale") == locale) & F.col("observed_date").isNotNull())
        .groupBy(F.col("observed_date").alias("date"), "locale_name")
        .agg(F.max("f_holiday").alias("h"))
    )


def national(observed_rows):
    return (
        observed_rows.filter("locale = 'National' AND observed_date IS NOT NULL")
        .groupBy(F.col("observed_date").alias("date"))
        .agg(F.max("f_holiday").alias("nat_h"))
    )


def _at_stores(observed_rows, stores, locale, place):
    """Holidays of a locale at every store in that place. Holidays are reduced to one row per
    (day, place) first, so a store meets a day at most once."""
    days = _by_place(observed_rows, locale)
    where = stores.select("store_nbr", as_text(F.col(place), "UNKNOWN").alias("locale_name"))
    return days.join(where, "locale_name").select("date", "store_nbr", "h")


def regional(observed_rows, stores):
    return _at_stores(observed_rows, stores, "Regional", "state")


def local(observed_rows, stores):
    return _at_stores(observed_rows, stores, "Local", "city")


def override(observed_rows, stores):
    """Regional and local holidays together, one row per (day, store)."""
    both = regional(observed_rows, stores).unionByName(local(observed_rows, stores))
    return both.groupBy("date", "store_nbr").agg(F.max("h").alias("h"))
