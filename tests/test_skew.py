"""One key holding a third of the rows must not end up in one task."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.coerce import add_target
from shelfcast.plans.features import FeatureEstimator
from workload import queries as Q
from workload import views as V

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down to test size."""
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_request_key_is_split(spark, small_partitions):
    sales = add_target(V.dense_sales(spark, SF))
    model = FeatureEstimator(tables=V.dense_tables(spark, SF), order=V.ORDER).fit(sales)
    day = dt.date(1998, 1, 5)
    hot = spark.range(0, 60_000, 1, 8).select(
        F.lit(day).alias("date"), F.lit(3).alias("store_nbr"), F.lit(7).alias("item_nbr"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    rest = spark.range(0, 60_000, 1, 8).select(
        F.date_add(F.lit(day), (F.col("id") % 40).cast("int")).alias("date"),
        (F.col("id") % 25).cast("int").alias("store_nbr"),
        (F.col("id") % 50).cast("int").alias("item_nbr"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    model.broadcast_bytes = 64 << 20
    out = model.transform(hot.unionByName(rest))
    out.write.format("noop").mode("overwrite").save()
    counted = out.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert out.count() == 120_000
    # Eight shuffle partitions, yet no task holds the 60,000 equal keys.
    assert counted[0] < 30_000 and counted[1] > 8


CARTESIAN = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.mark.parametrize(
    "name",
    [
        "daily_top_groups", "top_families_units", "items_fe", "store_fe", "holiday_override",
        "sales_lag_roll", "join_oil", "features_holdout", "forecast_grid", "naive_metrics",
    ],
)
def test_no_cross_join(spark, name):
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not CARTESIAN.search(plan)
