import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.metrics import regression_metrics, worst_errors
from shelfcast.operators.sampling import exact_sample
from shelfcast.operators.split import SplitSizes, fit_sizes_to, label_split, split_info, time_split
from tests.conftest import listed


@pytest.mark.parametrize(
    "days, total, expected",
    [(71, 84, (71, 11, 3, 57)), (71, 70, (70, 11, 3, 56)), (200, 84, (84, 14, 3, 67)), (5, 84, (5, 4, 0, 1))],
)
def test_sizes(spark, days, total, expected):
    s, latest = fit_sizes_to(dated(spark, days), total)
    assert latest == dt.date(2020, 1, 1) + dt.timedelta(days=days - 1)
    assert (s.total, s.test, s.gap, s.train) == expected


def dated(spark, days):
    return spark.range(days).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("date"), "id"
    )


def test_parts_are_disjoint_and_complete(spark):
    df = dated(spark, 100).withColumn("date", F.col("date").cast("string"))
    parts = [{r["id"] for r in p.collect()} for p in time_split(df, SplitSizes())]
    assert [len(p) for p in parts] == [67, 3, 14]
    assert set().union(*parts) == set(range(16, 100))
    assert max(parts[0]) < min(parts[1]) and max(parts[1]) < min(parts[2])
    labels = {r["split"]: r for r in split_info(label_split(df)).collect()}
    assert {k: v["n_rows"] for k, v in labels.items()} == {"train": 67, "gap": 3, "test": 14}
    assert labels["test"]["max_date"] == dt.date(2020, 1, 1) + dt.timedelta(days=99)


def test_no_rows(spark):
    empty = dated(spark, 0)
    assert label_split(empty).count() == 0
    with pytest.raises(ValueError):
        time_split(empty)
    with pytest.raises(ValueError):
        fit_sizes_to(empty)


def metrics_of(rows, pairs):
    df = rows(pairs, "y double, y_pred double").withColumns(
        {"y_log": F.col("y"), "y_pred_log": F.col("y_pred")}
    )
    return regression_metrics(df).first()


def test_metrics(rows):
    m = metrics_of(rows, [(1.0, 1.0), (2.0, 3.0), (6.0, 4.0)])
    assert math.isclose(m["RMSE_raw"], math.sqrt(5 / 3)) and m["MAE_raw"] == 1.0
    assert math.isclose(m["R2_raw"], 1 - 5 / 14) and m["Mean_y_true_raw"] == 3.0


def test_r2_of_a_constant(rows):
    assert metrics_of(rows, [(2.0, 1.0), (2.0, 2.0)])["R2_raw"] == 0.0
    assert metrics_of(rows, [(2.0, 2.0), (2.0, 2.0)])["R2_raw"] == 1.0
    assert metrics_of(rows, [(2.0, 2.0)])["R2_raw"] is None


def test_worst_errors(rows):
    df = rows([(1, 1.0, 5.0), (2, 1.0, 1.5), (3, 5.0, 1.0)], "k int, y double, y_pred double")
    assert [r["k"] for r in worst_errors(df, ["k"], rows=2).collect()] == [1, 3]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("string").alias("g"))
    first = listed(exact_sample(df, 1234, seed=1))
    assert len(first) == 1234 == len(set(first))
    assert sorted(first) == sorted(listed(exact_sample(df.repartition(5), 1234, seed=1)))
    assert sorted(first) != sorted(listed(exact_sample(df, 1234, seed=2)))
    assert exact_sample(df, 20_000).count() == 20_000 == exact_sample(df, 30_000).count()
    # No part of the table is favoured.
    assert 0.42 < sum(i for i, _ in first) / len(first) / 20_000 < 0.58


@pytest.mark.parametrize("wanted", [1, 10, 700, 999])
def test_sample_of_copies(spark, wanted):
    """Most rows equal: the cut falls inside the copies."""
    copies = spark.range(900).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    rest = spark.range(100).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b"))
    assert exact_sample(copies.union(rest), wanted).count() == wanted
