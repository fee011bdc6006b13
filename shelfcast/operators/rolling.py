"""Rolling means and lags.

Two kinds of frame, on purpose: transactions and oil roll over *rows* (recorded days),
sales roll over *calendar days*.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.scalars import day_number
from shelfcast.operators.dedup import keep_last
from shelfcast.operators.filters import trailing_days

ROLL = 14
LAG = 28
OIL_FALLBACK_ROWS = 30

KEY = ["store_nbr", "item_nbr", "date"]


def transactions_daily(transactions):
    """One row per store and day."""
    return (
        transactions.filter(F.col("store_nbr").isNotNull() & F.col("date").isNotNull())
        .groupBy("store_nbr", "date")
        .agg(F.coalesce(F.sum("transactions"), F.lit(0.0)).alias("transactions"))
    )


def transactions_roll(transactions, gap=0):
    """Mean of the 14 recorded days that end ``1 + gap`` recorded days back.

    The window runs on the daily table: a store contributes one row per day, however many
    raw rows it has.
    """
    frame = (
        Window.partitionBy("store_nbr").orderBy("date").rowsBetween(-(ROLL + gap), -(1 + gap))
    )
    return transactions_daily(transactions).select(
        "store_nbr", "date", F.avg("transactions").over(frame).alias("transactions_roll14")
    )


def transactions_last(rolls):
    """Each store's latest known roll."""
    known = rolls.filter(F.col("transactions_roll14").isNotNull())
    return known.groupBy("store_nbr").agg(F.max_by("transactions_roll14", "date").alias("last_roll"))


def oil_filled(oil):
    """One price per day with gaps filled forward.

    The window has no partition key, which is safe only because the table is first reduced
    to one row per calendar day: a century is 36,525 rows.
    """
    daily = keep_last(oil.filter(F.col("date").isNotNull()).select("date", "dcoilwtico"), ["date"])
    so_far = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("dcoilwtico", F.last("dcoilwtico", ignorenulls=True).over(so_far))


def oil_roll(oil):
    """Mean of the previous 14 recorded days' prices."""
    previous = Window.orderBy("date").rowsBetween(-ROLL, -1)
    return oil_filled(oil).select("date", F.avg("dcoilwtico").over(previous).alias("oil_roll14"))


def oil_fallback(rolls):
    """Mean of the last 30 rolls, for days without a price; 0 if there are no prices at all."""
    latest = rolls.orderBy(F.desc("date")).limit(OIL_FALLBACK_ROWS)
    mean = F.when(F.count(F.lit(1)) == 0, F.lit(0.0)).otherwise(F.avg("oil_roll14"))
    return latest.agg(mean.alias("oil_fallback"))


def sales_history(history, target, days=None, order=()):
    """Deduplicated (store, item, date, y): the last row wins, by ``order`` then by value.

    ``days`` keeps the latest day and that many days before it; ``None`` keeps all.
    """
    rows = history.select(*KEY, *[c for c in order if c not in KEY], F.col(target).alias("y"))
    rows = trailing_history(rows.filter(F.col("date").isNotNull()), days)
    return keep_last(rows, KEY, order).select(*KEY, "y")


def trailing_history(rows, days):
    """The latest day and ``days`` days before it; ``None`` keeps all."""
    return rows if days is None else trailing_days(rows, int(days) + 1)


def sales_lag_roll(history, requests, gap=0):
    """Lag 28 and 14-day mean for every distinct (store, item, date) in ``requests``.

    History (already one row per key) and the distinct request keys are stacked, and one window
    holds both calendar frames; the history moves once, for that window. Equal requests are reduced
    first: a (store, item) pair then contributes at most two rows per day, so no window partition
    can outgrow the calendar even when one key fills a third of the requests. A request has no
    value of its own, so it counts in no maximum, mean or count.
    """
    known = history.select(*KEY, F.col("y").cast("double").alias("y"), F.lit(0).alias("asked"))
    asked = requests.select(*KEY).distinct()
    asked = asked.select(*KEY, F.lit(None).cast("double").alias("y"), F.lit(1).alias("asked"))
    days = known.unionByName(asked)
    pair = Window.partitionBy("store_nbr", "item_nbr").orderBy(day_number(F.col("date")))
    lag = F.max("y").over(pair.rangeBetween(-(LAG + gap), -(LAG + gap)))
    recent = pair.rangeBetween(-(ROLL + gap), -(1 + gap))
    return (
        days.select(
            *KEY,
            "asked",
            lag.alias("sales_lag28"),
            F.avg("y").over(recent).alias("sales_roll14"),
            F.count("y").over(recent).cast("int").alias("sales_roll14_cnt"),
        )
        .filter("asked = 1")
        .drop("asked")
        .withColumn("sales_lag28_avail", F.col("sales_lag28").isNotNull().cast("int"))
        .withColumn("sales_roll14_frac", F.col("sales_roll14_cnt") / F.lit(float(ROLL)))
    )
