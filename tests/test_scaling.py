"""Steps that have to grow with the machines: matrix tasks, rows trained on, gathered rows, wide projections, joins done once."""

import math

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.coerce import add_target
from shelfcast.operators.split import fit_sizes_to, time_split
from shelfcast.plans import model
from shelfcast.plans.features import FeatureModel
from shelfcast.plans.formula import formula
from shelfcast.sources.registry import RunRegistry
from workload import queries as Q
from workload import views as V

SF = "/root/testdata/sf0.001"


class _Learner:
    """A formula that notes the rows of each task of its matrix."""

    def fit(self, matrix):
        self.rows = [r["count"] for r in matrix.groupBy(F.spark_partition_id()).count().collect()]
        return formula({"onpromo": 1.0}).fit(matrix)


def test_matrix_tasks_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "MATRIX_VALUES", (len(model.MODEL_FEATURES) + 1) * 200, raising=False)
    learner, config = _Learner(), model.TrainConfig(total_days=3650, sales_history_days=3650)
    meta = model.train(V.dense_sales(spark, SF), V.dense_tables(spark, SF), str(tmp_path / "run"), config, V.ORDER, learner=learner)
    assert sum(learner.rows) == meta["n_train_fit"] > 2000
    assert max(learner.rows) <= 200


SMALL = model.TrainConfig(total_days=3650, sales_history_days=3650, n_trees=4, max_depth=3, max_bins=32)


def _several_a_day(spark):
    """Sales with other units and flags beside each of their rows: 5 rows for each store, item and day."""
    sales = V.dense_sales(spark, SF).filter("l_orderkey % 4 = 0")
    more = spark.range(5).withColumnRenamed("id", "k")
    return sales.crossJoin(more).withColumns(
        {"unit_sales": F.col("unit_sales") + F.pmod(F.col("k") * 7 + F.col("l_orderkey"), F.lit(11)), "onpromotion": F.col("k") % 2 == 0}
    ).drop("k")


@pytest.mark.parametrize("extra", [[], ["l_linenumber"], ["unit_sales_log"]])
def test_trees_grow_from_one_row_for_equal_features(spark, tmp_path, monkeypatch, extra):
    sales, run_dir, seen = _several_a_day(spark), str(tmp_path / "run"), []
    plain = model.write_matrix
    monkeypatch.setattr(model, "write_matrix", lambda m, *a: seen.append(plain(m, *a)) or seen[-1])
    cols = [*model.MODEL_FEATURES, *extra]
    meta = model.train(sales, V.dense_tables(spark, SF, sales), run_dir, SMALL, V.ORDER, feature_cols=cols)
    sizes, latest = fit_sizes_to(sales, SMALL.total_days)
    train_rows, _, test_rows = time_split(add_target(sales), sizes, latest=latest)
    keys = ["date", "store_nbr", "item_nbr", "onpromotion", *extra]
    assert seen[0].count() == train_rows.select(*keys).distinct().count() <= meta["n_train_fit"] == train_rows.count()
    assert "unit_sales_log" in extra or seen[0].count() < 0.5 * meta["n_train_fit"]
    assert seen[0].agg(F.sum(model.WEIGHT)).first()[0] == meta["n_train_fit"]
    # The model is that of all rows.
    features = FeatureModel.load(spark, f"{run_dir}/state")
    every = model.align(features.transform(train_rows), cols, ["unit_sales_log"])
    whole = model.regressor(cols, SMALL).fit(every)
    published = RunRegistry(spark, run_dir).load(run_dir).model
    rows = features.transform(train_rows.unionByName(test_rows))
    pairs = [model.score(rows, m, cols).select("y_pred_log").collect() for m in (whole, published)]
    assert len({round(r[0], 6) for r in pairs[0]}) > 5
    assert [r[0] for r in pairs[1]] == pytest.approx([r[0] for r in pairs[0]], abs=1e-9)


def test_a_missing_label_is_refused(spark, tmp_path):
    sales = add_target(_several_a_day(spark))
    first = F.col("date") == F.lit(sales.agg(F.min("date")).first()[0])
    sales = sales.withColumn("unit_sales_log", F.when(~(first & F.col("onpromotion") & (F.col("unit_sales") > 0)), F.col("unit_sales_log")))
    assert sales.filter("unit_sales_log IS NULL").count()
    with pytest.raises(Exception, match="(?i)label"):
        model.train(sales, V.dense_tables(spark, SF, sales), str(tmp_path / "run"), SMALL, V.ORDER)


def test_few_matrix_rows_go_to_all_cores(rows, tmp_path, monkeypatch):
    table = rows([(float(i),) for i in range(1000)], "x double").coalesce(1)
    cores = table.sparkSession.sparkContext.defaultParallelism
    monkeypatch.setattr(model, "MATRIX_ROWS", 10, raising=False)
    read = model.write_matrix(table, str(tmp_path / "all"), 1000)
    assert read.rdd.getNumPartitions() == cores and read.agg(F.sum("x")).first()[0] == 499500
    monkeypatch.setattr(model, "MATRIX_ROWS", 600)
    assert model.write_matrix(table, str(tmp_path / "few"), 1000).rdd.getNumPartitions() == 2


@pytest.mark.parametrize("name", ["file_hashes", "source_fingerprint", "sampled_eval"])
def test_no_step_has_a_fixed_number_of_tasks(spark, monkeypatch, name):
    fixed = []
    for method in ("coalesce", "repartition"):

        def noted(self, first, *more, plain=getattr(type(spark.range(1)), method)):
            if isinstance(first, int):
                fixed.append(first)
            return plain(self, first, *more)

        monkeypatch.setattr(type(spark.range(1)), method, noted)
    rows = Q.QUERIES[name](spark, SF).collect()
    assert rows and fixed == []


def test_a_wide_table_is_rounded_as_one_array(rows):
    values = [0.1234565, -0.1234565, 2.5e-7, 1e300, math.inf, -math.inf, math.nan, -0.0, None, 1 / 3, 1234567.1234565]
    names = [f"c{i}" for i in range(2 * Q.WIDE)] if hasattr(Q, "WIDE") else [f"c{i}" for i in range(24)]
    table = rows([(i, *[v] * len(names), "x") for i, v in enumerate(values)], f"i int, {', '.join(f'{c} double' for c in names)}, s string")
    wide = Q.rounded(table)
    assert wide.columns == table.columns and wide.dtypes == table.dtypes
    want = [r[0] for r in table.select((F.round("c0", 6) + F.lit(0.0)).alias("r"), "i").orderBy("i").collect()]
    got = wide.orderBy("i").collect()
    for row, value in zip(got, want, strict=True):
        assert {repr(row[c]) for c in names} == {repr(value)}
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("round(") < 12


@pytest.mark.parametrize("name", ["formula_metrics", "formula_worst", "formula_period", "feature_matrix"])
def test_sales_are_joined_once(spark, monkeypatch, name):
    calls, plain = [], V.dense_sales
    monkeypatch.setattr(V, "dense_sales", lambda *a: calls.append(a) or plain(*a))
    assert Q.QUERIES[name](spark, SF).count() and len(calls) == 1
