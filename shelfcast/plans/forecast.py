"""Forecasts for single requests and for whole periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.functions.coerce import require_columns
from shelfcast.operators.filters import as_day
from shelfcast.operators.rolling import KEY
from shelfcast.plans.model import score
from shelfcast.sources.artifacts import exists
from shelfcast.sources.fingerprint import content_fingerprint

# Grid rows aimed at per task.
ROWS_PER_TASK = 1_000_000


def forecast_series(items, stores):
    """Every selected item in every selected store.

    The selected stores are one array value (a scalar subquery), in which each item expands in
    place, so nothing is joined and the series stay distributed by item.
    """
    if not hasattr(stores, "columns"):
        wanted = sorted({int(s) for s in stores})
        stores = items.sparkSession.createDataFrame([(s,) for s in wanted], "store_nbr bigint")
    ids = F.array_sort(F.collect_set(F.col("store_nbr").cast("bigint")))
    picked = items.filter(F.col("item_nbr").isNotNull()).select(F.col("item_nbr").cast("bigint")).distinct()
    return picked.select(F.explode(stores.agg(ids.alias("ids")).scalar()).alias("store_nbr"), "item_nbr")


def forecast_grid(items, stores, start, end, onpromotion=False, promotions=None):
    """One request per day of the period, selected store and selected item.

    ``items`` is a table with ``item_nbr``; ``stores`` a table with ``store_nbr`` or a list of
    numbers. The series (items by stores) are dealt out before each expands into its days, so few
    items with many stores and days still make many tasks. A promotion table with (date,
    store_nbr, item_nbr, onpromotion) replaces the single ``onpromotion`` value where it has a row.
    """
    series = forecast_series(items, stores)
    first, last = sorted([as_day(start), as_day(end)])
    total = series.count() * ((last - first).days + 1)
    if not total:
        raise ValueError("select at least one store and one item")
    grid = (
        series.repartition(-(-total // ROWS_PER_TASK), "store_nbr", "item_nbr")
        .withColumn("date", F.explode(F.sequence(F.lit(first), F.lit(last))))
        .select("date", "store_nbr", "item_nbr")
    )
    if promotions is None:
        return grid.withColumn("onpromotion", F.lit(bool(onpromotion)))
    require_columns(promotions, [*KEY, "onpromotion"])
    flags = promotions.groupBy(*KEY).agg(F.max("onpromotion").alias("onpromotion"))
    return grid.join(flags, KEY, "left").withColumn(
        "onpromotion", F.coalesce(F.col("onpromotion"), F.lit(bool(onpromotion)))
    )


def forecast(requests, run, series=None):
    """``requests`` plus ``y_pred_log`` and ``y_pred``.

    ``series`` are the (store_nbr, item_nbr) that are asked for; when they are few, only their
    history is read.
    """
    enriched = run.features.enrich(requests, series)
    return score(enriched, run.model, run.feature_cols, requests.columns)


def forecast_point(spark, run, date, store_nbr, item_nbr, onpromotion=False):
    row = [(as_day(date), int(store_nbr), int(item_nbr), bool(onpromotion))]
    schema = "date date, store_nbr bigint, item_nbr bigint, onpromotion boolean"
    request = spark.createDataFrame(row, schema)
    return forecast(request, run, request.select("store_nbr", "item_nbr"))


def forecast_period(run, items, stores, start, end, onpromotion=False, promotions=None):
    grid = forecast_grid(items, stores, start, end, onpromotion, promotions)
    return forecast(grid, run, forecast_series(items, stores))


FINISHED = "run_id string, request string, date date"


def _finished(spark, path):
    folder = f"{path}/days"
    return spark.read.schema(FINISHED).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], FINISHED)


def _spans(days, most):
    """Ascending days as (first, last) of neighbouring ones, ``most`` at once."""
    spans = []
    for day in days:
        if spans and day == spans[-1][1] + dt.timedelta(days=1) and (day - spans[-1][0]).days < most:
            spans[-1] = (spans[-1][0], day)
        else:
            spans.append((day, day))
    return spans


def write_forecast(run, items, stores, start, end, path, onpromotion=False, promotions=None, days_at_once=7):
    """Writes a period's forecast under ``path``, partitioned by day, and returns the days written now.

    Days go a few at a time, and are listed as finished once their rows are there. A call that
    repeats an interrupted one (same run, series and promotions) writes the days that are missing; a
    request of another kind writes its days anew.
    """
    spark, path = items.sparkSession, path.rstrip("/")
    series = forecast_series(items, stores)
    flags = "" if promotions is None else content_fingerprint(promotions.select(*KEY, "onpromotion"))
    request = f"{content_fingerprint(series)} {bool(onpromotion)} {flags}"
    mine = _finished(spark, path).filter((F.col("run_id") == str(run.run_id)) & (F.col("request") == request))
    done = {r["date"] for r in mine.select("date").distinct().collect()}
    first, last = sorted([as_day(start), as_day(end)])
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    written = []
    for low, high in _spans([d for d in days if d not in done], days_at_once):
        rows = forecast(forecast_grid(items, stores, low, high, onpromotion, promotions), run, series)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
        writer.parquet(f"{path}/rows")
        part = [low + dt.timedelta(days=n) for n in range((high - low).days + 1)]
        listed = spark.createDataFrame([(str(run.run_id), request, d) for d in part], FINISHED)
        listed.coalesce(1).write.mode("append").parquet(f"{path}/days")
        written += part
    return written


def read_forecast(spark, path, run_id):
    """The rows of the days that a run finished under ``path``."""
    days = _finished(spark, path.rstrip("/")).filter(F.col("run_id") == str(run_id)).select("date").distinct()
    wanted = [r["date"] for r in days.collect()]
    rows = spark.read.parquet(f"{path.rstrip('/')}/rows")
    return rows.filter(F.col("date").isin(wanted)) if wanted else rows.limit(0)
