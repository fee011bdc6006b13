"""Evaluation of a published model on the latest days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.coerce import as_double, parse_flag, require_columns
from shelfcast.operators.filters import trailing_days
from shelfcast.operators.metrics import regression_metrics, worst_errors
from shelfcast.operators.sampling import exact_sample
from shelfcast.plans.model import score
from shelfcast.session import shared_dir, written
from shelfcast.sources.readers import SALES_COLUMNS, evaluation_columns

REQUEST = ["date", "store_nbr", "item_nbr", "onpromotion"]


@dataclass
class Evaluation:
    scored: DataFrame
    metrics: DataFrame
    worst: DataFrame


def validation_rows(sales, eval_days=14, max_rows=None, seed=42):
    """The latest ``eval_days`` with known sales (returns as 0): all rows, or a sample of exactly
    ``max_rows`` when there are more and a sample is asked for."""
    require_columns(sales, SALES_COLUMNS)
    rows = evaluation_columns(sales)
    rows = rows.withColumns(
        {"onpromotion": parse_flag(rows, "onpromotion"), "unit_sales": as_double(F.col("unit_sales"))}
    ).filter(F.col("unit_sales").isNotNull())
    rows = rows.withColumn("unit_sales", F.greatest(F.col("unit_sales"), F.lit(0.0)))
    latest = trailing_days(rows, eval_days)
    return latest if max_rows is None else exact_sample(latest, max_rows, seed)


def evaluate(sales, run, eval_days=14, max_rows=None, seed=42):
    """Scores the validation rows, then measures them.

    The rows are written before they are enriched, because enriching reads them twice (as rows and
    as keys) and a sample is not worth drawing twice; so are the scored rows.
    """
    spark = sales.sparkSession
    rows = written(validation_rows(sales, eval_days, max_rows, seed), shared_dir(spark, "validation"))
    enriched = run.features.enrich(rows)
    path = shared_dir(spark, "evaluation")
    score(enriched, run.model, run.feature_cols, [*REQUEST, "unit_sales"]).withColumns(
        {"y": F.col("unit_sales"), "y_log": F.log1p("unit_sales")}
    ).drop("unit_sales").write.parquet(path)
    scored = spark.read.parquet(path)
    report = scored.select(
        *REQUEST, F.col("y").alias("y_true_unit_sales"), F.col("y_pred").alias("y_pred_unit_sales")
    )
    worst = worst_errors(report, REQUEST, y="y_true_unit_sales", pred="y_pred_unit_sales")
    return Evaluation(scored, regression_metrics(scored), worst)
