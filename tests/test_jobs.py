import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfcast.plans import jobs
from shelfcast.plans.evaluate import evaluate, validation_rows
from shelfcast.plans.forecast import forecast, forecast_grid, forecast_period, forecast_point
from shelfcast.plans.jobs import build_now, run_if_new
from shelfcast.plans.model import TrainConfig, train
from shelfcast.sources.artifacts import exists, export_csv, load_metadata, load_metrics, read_json
from shelfcast.sources.fingerprint import content_fingerprint, file_signature
from shelfcast.sources.registry import RUNS_SCHEMA, RunRegistry
from workload import views as V

SF = "/root/testdata/sf0.001"
CONFIG = TrainConfig(
    weeks_window=520, total_days=3650, sales_history_days=3650, n_trees=3, max_depth=3
)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("registry"))
    V.dense_sales(spark, SF).write.parquet(f"{folder}/sales")
    return folder


@pytest.fixture(scope="module")
def tables(spark):
    return V.dense_tables(spark, SF)


@pytest.fixture(scope="module")
def published(spark, root, tables):
    return run_if_new(spark, f"{root}/sales", tables, root, CONFIG, V.ORDER)


@pytest.fixture(scope="module")
def run(spark, root, published):
    return RunRegistry(spark, root).load_latest()


def test_published_run(spark, root, published):
    meta = published["metadata"]
    assert meta["test_days"] == 14 and meta["gap_days"] == 3 and meta["n_features"] == 27
    assert meta["n_train_fit"] > 0 and meta["n_test"] > 0
    assert meta["train_max_date"] < meta["gap_min_date"] <= meta["gap_max_date"] < meta["test_min_date"]
    assert published["feature_cols"] == sorted(published["feature_cols"])
    assert published["metrics"]["RMSE_log"] == pytest.approx(meta["RMSE_log"])
    assert load_metadata(spark, published["run_dir"]) == meta
    assert RunRegistry(spark, root).runs().count() == 1


def test_unchanged_source_is_skipped(spark, root, tables, published, monkeypatch):
    assert run_if_new(spark, f"{root}/sales", tables, root, CONFIG, V.ORDER) is None
    # Rewritten files with the same rows do not count as a change either.
    copy = f"{root}/sales_copy"
    spark.read.parquet(f"{root}/sales").repartition(3).write.parquet(copy)
    assert run_if_new(spark, copy, tables, root, CONFIG, V.ORDER) is None
    # Their listing is noted, so a third call reads no rows.
    noted = read_json(spark, f"{root}/listing.json")
    assert noted == {"run_id": published["run_id"], "file_signature": file_signature(spark, copy)}
    monkeypatch.setattr(jobs, "content_fingerprint", lambda df: pytest.fail("the content was read again"))
    assert run_if_new(spark, copy, tables, root, CONFIG, V.ORDER) is None


def test_a_broken_path_is_not_an_absent_one(spark, tmp_path):
    assert exists(spark, str(tmp_path)) and not exists(spark, str(tmp_path / "none"))
    with pytest.raises(Exception, match="nosuchscheme"):
        exists(spark, "nosuchscheme://bucket/runs_table")


def test_same_seed_same_scores(spark, root, tables, run, published, tmp_path):
    again = train(spark.read.parquet(f"{root}/sales"), tables, str(tmp_path / "again"), CONFIG, V.ORDER)
    assert again["RMSE_log"] == pytest.approx(run.metadata["RMSE_log"])


def test_better_than_the_mean_on_train_rows(spark, root, run):
    sales = spark.read.parquet(f"{root}/sales").select("date", "store_nbr", "item_nbr", "onpromotion", "unit_sales")
    scored = forecast(sales, run).withColumn("y", F.log1p(F.greatest("unit_sales", F.lit(0.0))))
    mse, var = scored.agg(F.avg((F.col("y") - F.col("y_pred_log")) ** 2), F.var_pop("y")).first()
    assert mse < var


def test_evaluation(spark, root, run):
    sales = spark.read.parquet(f"{root}/sales")
    result = evaluate(sales, run, eval_days=28)
    metrics = result.metrics.first()
    n = validation_rows(sales, 28).count()
    assert metrics["n_rows"] == n == result.scored.count() > 0
    assert metrics["RMSE_raw"] >= metrics["MAE_raw"] >= 0
    worst = [r["abs_err"] for r in result.worst.collect()]
    assert worst == sorted(worst, reverse=True) and len(worst) == min(n, 200)
    assert evaluate(sales, run, eval_days=28, max_rows=5).scored.count() == 5
    with pytest.raises(ValueError, match="onpromotion"):
        validation_rows(sales.drop("onpromotion"))


def test_forecasts(spark, run, tables, tmp_path):
    row = forecast_point(spark, run, "2001-12-01", 1, 1, True).first()
    assert row["onpromotion"] is True
    assert row["y_pred"] == pytest.approx(pow(2.718281828459045, row["y_pred_log"]) - 1)
    items = tables.items.filter("item_nbr <= 3")
    as_table = forecast_grid(items, tables.stores.filter("store_nbr IN (1, 2)"), "2001-12-07", "2001-12-01")
    assert as_table.count() == 42
    period = forecast_period(run, items, [1, 2], "2001-12-07", "2001-12-01")
    assert period.count() == 3 * 2 * 7
    export_csv(period, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 42 and "y_pred" in back.columns


def test_grid_with_promotions(spark, rows):
    items = rows([(1,), (2,), (1,)], "item_nbr int")
    promo = rows([(dt.date(2020, 1, 2), 5, 1, True)], "date date, store_nbr int, item_nbr int, onpromotion boolean")
    grid = forecast_grid(items, [5, 5], "2020-01-01", "2020-01-03", promotions=promo)
    assert grid.count() == 6 and grid.filter("onpromotion").count() == 1
    with pytest.raises(ValueError):
        forecast_grid(items, [], "2020-01-01", "2020-01-03")


def test_empty_split_is_an_error(spark, root, tables, tmp_path):
    one_day = spark.read.parquet(f"{root}/sales").filter("date = '1998-01-05'").limit(1)
    with pytest.raises(ValueError):
        train(one_day, tables, str(tmp_path / "x"), CONFIG)


def test_fingerprint(rows):
    schema = "a int, b string"
    base = content_fingerprint(rows([(1, "x"), (2, None), (3, "z")], schema))
    assert base == content_fingerprint(rows([(3, "z"), (1, "x"), (2, None)], schema).repartition(3))
    assert base != content_fingerprint(rows([(1, "x"), (2, "y"), (3, "z")], schema))
    assert base != content_fingerprint(rows([(1, "x"), (2, None), (3, "z"), (3, "z")], schema))
    swapped = [content_fingerprint(rows([r], "a int, b int")) for r in ((1, None), (None, 1))]
    assert swapped[0] != swapped[1]


def test_latest_is_by_run_id(spark, tmp_path):
    registry = RunRegistry(spark, str(tmp_path))
    assert registry.latest() is None and registry.latest_metadata() == {}
    with pytest.raises(FileNotFoundError):
        registry.load_latest()
    for run_id in ("2024_1", "2024_3", "2024_2"):
        row = (run_id, "d", None, None, [], {}, json.dumps({"id": run_id}))
        spark.createDataFrame([row], RUNS_SCHEMA).write.mode("append").parquet(registry.runs_path)
    assert registry.latest()["run_id"] == "2024_3" and registry.latest_metadata() == {"id": "2024_3"}


def test_unfinished_run_is_not_published(spark, tmp_path):
    registry = RunRegistry(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="features.json"):
        registry.publish("r1", {})
    assert registry.latest() is None


def test_metadata_files(spark, tmp_path):
    assert load_metadata(spark, str(tmp_path)) == {} and load_metrics(spark, str(tmp_path)) is None
    (tmp_path / "metrics.json").write_text('{\n "a": 1\n}')
    assert load_metrics(spark, str(tmp_path)) == {"a": 1}
    (tmp_path / "metadata.json").write_text('{"b": {"c": [1, 2]}}')
    assert load_metrics(spark, str(tmp_path)) == {"b": {"c": [1, 2]}} == load_metadata(spark, str(tmp_path))


def test_build_now_writes_a_summary(spark, root, tables, tmp_path):
    out = build_now(spark, f"{root}/sales", tables, str(tmp_path), CONFIG, order=V.ORDER)
    saved = read_json(spark, f"{tmp_path}/build_summary.json")
    assert saved["latest"]["run_id"] == out["latest"]["run_id"]
    assert saved["metrics"]["RMSE_raw"] == out["metrics"]["RMSE_raw"]
