"""Lenient conversions: a value that does not convert becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings accepted as "true", and the order in which a missing sales column
# is replaced.
TRUE_WORDS = ["true", "1", "t", "yes", "y"]
SALES_FALLBACKS = ["unit_sales_pos", "unit_sales_clean", "unit_sales"]

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def as_double(col):
    """Number or null; NaN counts as missing."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_int(df, name):
    """Whole number or null; decimals are cut, so "3.7" gives 3."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, _INTEGERS):
        return col.cast("int")
    if isinstance(df.schema[name].dataType, T.LongType):
        return col.try_cast("int")
    return as_double(col).try_cast("int")


def as_id(df, name):
    """Store or item number, 64 bits wide, or null; decimals are cut."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (*_INTEGERS, T.LongType)):
        return col.cast("bigint")
    # Text is read as a whole number first: a double would round ids of 16 digits and more.
    whole = F.trim(col.cast("string")).try_cast("decimal(38,6)")
    return F.coalesce(whole.try_cast("bigint"), as_double(col).try_cast("bigint"))


def as_date(df, name):
    """Calendar day or null. Typed columns use a plain cast so that date filters still
    reach the file scan."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, _TIMESTAMPS):
        return F.col(name).cast("date")
    if isinstance(kind, T.StringType):
        return F.trim(F.col(name)).try_cast("date")
    return F.lit(None).cast("date")


def as_text(col, default):
    """Trimmed text, ``default`` for null."""
    return F.trim(F.coalesce(col.cast("string"), F.lit(default)))


def parse_flag(df, name):
    """One yes/no rule for every source type; null and unknown words are false."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.BooleanType):
        flag = col
    elif isinstance(kind, T.NumericType):
        # Decimals are cut to whole numbers first, so 0.5 counts as 0.
        flag = F.abs(as_double(col)) >= 1
    else:
        flag = F.lower(F.trim(col.cast("string"))).isin(TRUE_WORDS)
    return F.coalesce(flag, F.lit(False))


def positive(col):
    """Units sold, with returns (negative) and missing values counted as 0."""
    return F.greatest(F.coalesce(as_double(col), F.lit(0.0)), F.lit(0.0))


def sales_column(df, name):
    """``name`` if present, else the first known sales column."""
    for candidate in [name, *SALES_FALLBACKS]:
        if candidate in df.columns:
            return candidate
    raise ValueError(f"no sales column: '{name}' is missing and so are {SALES_FALLBACKS}")


def require_columns(df, names):
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def keep_existing(df, names):
    """Projection on those of ``names`` that the table has."""
    return df.select(*[n for n in names if n in df.columns])


def not_null(col, name):
    """Fails the job on a null key instead of scoring it silently."""
    return F.coalesce(col, F.raise_error(F.lit(f"null value in key column {name}")))


def add_target(df, y_col="unit_sales"):
    """``unit_sales_clean`` (returns as 0) and ``unit_sales_log``, each only if absent."""
    if "unit_sales_clean" not in df.columns:
        require_columns(df, [y_col])
        df = df.withColumn("unit_sales_clean", positive(F.col(y_col)))
    if "unit_sales_log" not in df.columns:
        df = df.withColumn("unit_sales_log", F.log1p("unit_sales_clean"))
    return df
