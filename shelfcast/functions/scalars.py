"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

EXP_LIMIT = 50.0


def day_number(col):
    """Days since 1970-01-01: an integer, so calendar-range window frames can use it."""
    return F.unix_date(col)


def weekday(col):
    """Monday 0 to Sunday 6."""
    return F.weekday(col)


def calendar_columns(col):
    """The five calendar features of a date column."""
    return {
        "year": F.year(col),
        "month": F.month(col),
        "day": F.dayofmonth(col),
        "dow": weekday(col),
        "is_weekend": (weekday(col) >= 5).cast("int"),
    }


def iso_year(col):
    return F.extract(F.lit("YEAROFWEEK"), col).cast("int")


def iso_week(col):
    return F.weekofyear(col)


def week_label(year, week):
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def store_day_key(store, day):
    """One number per store and day: store * 1e6 + yyyymmdd, in 64 bits, so no wrap-around."""
    ymd = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return store.cast("bigint") * F.lit(1000000).cast("bigint") + ymd.cast("bigint")


def series_label(*cols):
    return F.concat_ws(" · ", *[c.cast("string") for c in cols])


def units_from_log(col):
    """Inverse of log1p with the input held to [-50, 50]; not floored at 0."""
    return F.expm1(F.least(F.greatest(col, F.lit(-EXP_LIMIT)), F.lit(EXP_LIMIT)))


def ratio(num, den, empty=0.0):
    """``num / den``, or ``empty`` where there is nothing to divide by."""
    fallback = F.lit(None).cast("double") if empty is None else F.lit(float(empty))
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(fallback)


def finite(col):
    """Null, NaN and infinities as 0."""
    number = col.cast("double")
    bad = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(F.coalesce(number, F.lit(0.0)))
