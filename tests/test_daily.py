import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.coerce import add_target
from shelfcast.plans import jobs
from shelfcast.plans.daily import DailyState
from shelfcast.plans.features import STATE_KEYS, FeatureEstimator
from shelfcast.plans.formula import FormulaModel, formula
from shelfcast.plans.jobs import run_if_new, window_fingerprint
from shelfcast.plans.model import TrainConfig, train
from shelfcast.sources.fingerprint import FileHashes, content_fingerprint, total_signature
from shelfcast.sources.readers import RetailTables, coerce_sales
from shelfcast.sources.registry import RunRegistry
from workload import views as V

SF = "/root/testdata/sf0.001"
CONFIG = TrainConfig(weeks_window=520, total_days=3650, sales_history_days=3650)
TERMS = {"sales_roll14": 0.5, "store_freq": 2.0, "onpromo": -0.25}


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily") / "sales")
    recent = V.dense_sales(spark, SF).filter("date >= '1998-09-15'")  # two and a half months
    add_target(recent).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tables(spark):
    made = vars(V.dense_tables(spark, SF))
    return RetailTables(**{name: spark.createDataFrame(t.collect(), t.schema).coalesce(1) for name, t in made.items()})


def estimator(tables):
    return FeatureEstimator(tables=tables, feature_gap_days=3, sales_history_days=40, order=V.ORDER)


def same_state(a, b):
    for name, keys in STATE_KEYS.items():
        x, y = (m.tables[name].select(*sorted(m.tables[name].columns)) for m in (a, b))
        rows = [sorted(map(str, t.select(*[F.round(c, 9).alias(c) if k == "double" else c for c, k in t.dtypes]).collect())) for t in (x, y)]
        assert rows[0] == rows[1], name
    assert a.n_rows == b.n_rows and a.oil_fallback == b.oil_fallback


def test_one_more_day_equals_a_fit_from_scratch_and_reads_that_day_only(spark, sales, tables, tmp_path):
    latest = sales.agg(F.max("date")).first()[0]
    daily = DailyState(spark, str(tmp_path / "state"), order=V.ORDER)
    before = sales.filter(F.col("date") < F.lit(latest))
    assert len(daily.add_new(before)) == before.select("date").distinct().count()
    same_state(estimator(tables).fit_daily(daily), estimator(tables).fit(before))
    # rows of earlier days fail when they are read
    guarded = sales.withColumn("item_nbr", F.when(F.col("date") < F.lit(latest), F.raise_error(F.lit("an old day was read")).cast("bigint")).otherwise(F.col("item_nbr")))
    assert daily.add_new(guarded) == [latest] and daily.add_new(guarded) == []
    same_state(estimator(tables).fit_daily(daily), estimator(tables).fit(sales))
    first = latest - dt.timedelta(days=50)
    span = sales.filter(F.col("date").between(F.lit(first), F.lit(latest)))
    same_state(estimator(tables).fit_daily(daily, first, latest), estimator(tables).fit(span))


def test_changed_and_removed_days_are_found(spark, sales, tables, tmp_path):
    daily = DailyState(spark, str(tmp_path / "state"), order=V.ORDER)
    days = [r[0] for r in sales.select("date").distinct().orderBy("date").collect()]
    assert daily.refresh(sales) == days and daily.refresh(sales) == []
    changed = sales.filter(F.col("date") != F.lit(days[3])).withColumn(
        "unit_sales_log", F.when(F.col("date") == F.lit(days[5]), 1.5).otherwise(F.col("unit_sales_log"))
    )
    assert daily.refresh(changed) == [days[5]]
    same_state(estimator(tables).fit_daily(daily), estimator(tables).fit(changed))


def test_an_interrupted_update_leaves_the_former_days(spark, sales, tmp_path, monkeypatch):
    daily = DailyState(spark, str(tmp_path / "state"), order=V.ORDER)
    latest = sales.agg(F.max("date")).first()[0]
    before = sales.filter(F.col("date") < F.lit(latest))
    daily.add_new(before)
    with monkeypatch.context() as m:
        m.setattr(DailyState, "_list", lambda self, sums: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            daily.add_new(sales)
    assert daily.days().count() == before.select("date").distinct().count()
    assert daily.counts().filter("store_nbr IS NOT NULL").agg(F.sum("n")).first()[0] == before.count()
    assert daily.history().agg(F.max("date")).first()[0] < latest
    assert daily.add_new(sales) == [latest]


def test_only_new_files_are_hashed(spark, sales, tmp_path):
    source = str(tmp_path / "sales")
    raw = sales.drop("unit_sales_log", "unit_sales_clean")
    raw.repartition(4).write.parquet(source)
    hashes = FileHashes(spark, str(tmp_path / "hashes"))
    whole = lambda: content_fingerprint(coerce_sales(spark.read.parquet(source)))
    assert total_signature(hashes.update(source, coerce_sales)) == whole() and hashes.scanned == 4
    assert total_signature(hashes.update(source, coerce_sales)) == whole() and hashes.scanned == 0
    raw.limit(7).coalesce(1).write.mode("append").parquet(source)
    assert total_signature(hashes.update(source, coerce_sales)) == whole() and hashes.scanned == 1
    raw.limit(0).coalesce(1).write.mode("append").parquet(source)  # a file without rows
    assert total_signature(hashes.update(source, coerce_sales)) == whole() and hashes.scanned == 1
    hashes.update(source, coerce_sales)
    assert hashes.scanned == 0
    raw.limit(9).repartition(2).write.mode("overwrite").parquet(source)  # all others are gone
    assert total_signature(hashes.update(source, coerce_sales)) == whole() and hashes.scanned == 2


def test_the_window_fingerprint_is_that_of_a_scan(spark, sales, tmp_path):
    source = str(tmp_path / "sales")
    sales.select("date", "store_nbr", "item_nbr", "onpromotion", "unit_sales").repartition(3).write.parquet(source)
    config = TrainConfig(weeks_window=30)
    got = window_fingerprint(spark, source, str(tmp_path / "h"), config)
    assert got == content_fingerprint(jobs._trained_on(spark, source, config, (), None, None))


def test_runs_with_and_without_kept_hashes_agree(spark, sales, tables, tmp_path):
    source, root = str(tmp_path / "sales"), str(tmp_path / "runs")
    sales.drop("unit_sales_log", "unit_sales_clean").write.parquet(source)
    daily = DailyState(spark, str(tmp_path / "state"), order=V.ORDER)
    first = run_if_new(spark, source, tables, root, CONFIG, V.ORDER, learner=formula(TERMS, 0.1), daily=daily)
    assert first["metadata"]["model_type"] == "FormulaModel"
    spark.read.parquet(source).repartition(2).write.parquet(f"{source}_copy")
    assert run_if_new(spark, f"{source}_copy", tables, root, CONFIG, V.ORDER, incremental=False) is None
    again = train(spark.read.parquet(source), tables, str(tmp_path / "scan"), CONFIG, V.ORDER, learner=formula(TERMS, 0.1))
    assert again["RMSE_raw"] == pytest.approx(first["metadata"]["RMSE_raw"])


def test_a_formula_is_saved_loaded_and_exact(spark, sales, tables, tmp_path):
    registry = RunRegistry(spark, str(tmp_path))
    meta = train(sales, tables, registry.run_dir("r1"), CONFIG, V.ORDER, learner=formula(TERMS, 0.1))
    registry.publish("r1", meta)
    run = registry.load_latest()
    model = run.model.stages[0]
    assert isinstance(model, FormulaModel) and model.terms() == TERMS and model.getOrDefault("intercept") == 0.1
    rows = spark.createDataFrame([(2.0, 0.5, 1.0), (0.0, 0.0, 0.0)], "sales_roll14 double, store_freq double, onpromo double")
    assert [r["y_pred_log"] for r in run.model.transform(rows).collect()] == [0.1 + 0.5 * 2.0 + 2.0 * 0.5 - 0.25, 0.1]
    with pytest.raises(ValueError, match="store_freq"):
        model.transform(rows.drop("store_freq"))
