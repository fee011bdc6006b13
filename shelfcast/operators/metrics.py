"""Regression metrics in one aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

WORST_ROWS = 200


def error_columns(y, pred, suffix):
    """RMSE, MAE and R2 aggregates of a (true, predicted) pair.

    The total sum of squares is n * population variance, which Spark merges stably across
    partitions. A constant target gives R2 = 1 for a perfect fit, else 0; fewer than two
    rows give null.
    """
    y, pred = F.col(y), F.col(pred)
    err = y - pred
    n = F.count(err)
    sse = F.sum(err * err)
    sst = F.var_pop(y) * n
    r2 = F.when(n < 2, F.lit(None).cast("double")).when(sst > 0, 1 - sse / F.when(sst > 0, sst))
    r2 = r2.otherwise(F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return [
        F.sqrt(F.avg(err * err)).alias(f"RMSE_{suffix}"),
        F.avg(F.abs(err)).alias(f"MAE_{suffix}"),
        r2.alias(f"R2_{suffix}"),
    ]


def regression_metrics(scored, y_log="y_log", pred_log="y_pred_log", y_raw="y", pred_raw="y_pred"):
    """Metrics in log space and in units, with both means, from one pass over the rows."""
    return scored.agg(
        *error_columns(y_log, pred_log, "log"),
        *error_columns(y_raw, pred_raw, "raw"),
        F.avg(y_raw).alias("Mean_y_true_raw"),
        F.avg(pred_raw).alias("Mean_y_pred_raw"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def worst_errors(scored, keys, rows=WORST_ROWS, y="y", pred="y_pred"):
    """The rows with the largest absolute error."""
    off = scored.withColumn("abs_err", F.abs(F.col(y) - F.col(pred)))
    return off.orderBy(F.desc("abs_err"), *keys).limit(int(rows))
