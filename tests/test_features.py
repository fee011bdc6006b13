import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.coerce import add_target
from shelfcast.operators import frequency as Q
from shelfcast.plans import features
from shelfcast.plans.features import FEATURES, FeatureEstimator, FeatureModel, key_counts
from shelfcast.plans.model import MODEL_FEATURES, align, numeric_features
from shelfcast.sources.readers import RetailTables
from tests.conftest import listed
from workload import views as V

SF = "/root/testdata/sf0.001"
GAP = 3


@pytest.fixture(scope="module")
def dense(spark):
    path = spark.conf.get("spark.checkpoint.dir") + "/dense_sales"
    V.dense_sales(spark, SF).write.mode("overwrite").parquet(path)
    return add_target(spark.read.parquet(path))


def fit(dense, spark, **kwargs):
    options = {
        "tables": V.dense_tables(spark, SF),
        "feature_gap_days": GAP,
        "sales_history_days": 36_500,
        "order": V.ORDER,
        **kwargs,
    }
    return FeatureEstimator(**options).fit(dense)


@pytest.fixture(scope="module")
def model(spark, dense):
    return fit(dense, spark)


def table(df):
    return sorted(map(str, df.collect()))


def test_adds_25_columns_and_no_rows(dense, model):
    out = model.transform(dense)
    assert out.columns == [*dense.columns, *FEATURES] and len(FEATURES) == 25
    assert out.count() == dense.count()
    assert len(MODEL_FEATURES) == 27


def test_saved_model_gives_the_same(spark, dense, model, tmp_path):
    model.save(str(tmp_path / "copy"))
    again = FeatureModel.load(spark, str(tmp_path / "copy"))
    assert again.gap == GAP and again.target == "unit_sales_log"
    assert table(again.transform(dense)) == table(model.transform(dense))


def test_joins_without_broadcast_give_the_same(spark, dense, model):
    big = FeatureModel.load(spark, model.path)
    big.broadcast_bytes = 0
    assert table(big.transform(dense)) == table(model.transform(dense))


def test_dated_tables_are_cut_before_broadcast(spark, dense, model):
    latest = dense.agg(F.max("date")).first()[0]
    recent = dense.filter(F.col("date") >= F.lit(latest - dt.timedelta(days=30)))
    tight = FeatureModel.load(spark, model.path)
    # Too little for the whole (store, day) table, enough for its last month.
    tight.broadcast_bytes = tight.n_rows["store_day"] * 8
    out = tight.transform(recent)

    def join_on_store_and_day(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"(\w+Join) \[store_nbr#\d+L?, date#\d+\]", plan)

    # Only what the model itself decides to broadcast, not what Spark finds tiny.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert join_on_store_and_day(out) == ["BroadcastHashJoin"]
        assert join_on_store_and_day(tight.transform(dense)) == ["SortMergeJoin"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert table(out) == table(model.transform(recent))


def test_cut_history_gives_the_same(dense, model):
    few = dense.filter("store_nbr = 3")
    cut = model.enrich(few, few.select("store_nbr", "item_nbr"))
    assert table(cut) == table(model.enrich(few))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(store_nbr,3)" in plan


def test_many_series_read_the_whole_history(dense, model, monkeypatch):
    monkeypatch.setattr(features, "INLINE_IDS", 2)
    assert table(model.enrich(dense, dense.select("store_nbr", "item_nbr").distinct())) == table(model.enrich(dense))


def test_no_leakage(spark, dense, model):
    """Changing sales after t-(G+1) leaves the features of day t alone."""
    t = dense.agg(F.max("date")).first()[0]
    changed = dense.withColumns(
        {
            c: F.when(F.col("date") > F.lit(t - dt.timedelta(days=GAP + 1)), F.lit(99.0)).otherwise(F.col(c))
            for c in ("unit_sales_clean", "unit_sales_log")
        }
    )
    today = dense.filter(F.col("date") == F.lit(t)).select("date", "store_nbr", "item_nbr")
    other = fit(changed, spark)
    assert table(other.transform(today)) == table(model.transform(today))


def test_frequencies_sum_to_one(dense, model):
    for name, col in (("store", "store_freq"), ("item", "item_freq")):
        assert model.tables[name].agg(F.sum(col)).first()[0] == pytest.approx(1)


def test_null_keys_fail(dense, model):
    bad = dense.limit(1).withColumn("store_nbr", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="null value in key column store_nbr"):
        model.transform(bad).collect()


def test_target_is_required(spark, dense):
    with pytest.raises(ValueError, match="add_target"):
        fit(dense.drop("unit_sales_clean", "unit_sales_log"), spark)


def test_feature_names_must_be_free(dense, model):
    with pytest.raises(ValueError, match="year"):
        model.transform(dense.withColumn("year", F.lit(1)))
    with pytest.raises(ValueError, match="nat_h"):
        model.transform(dense.withColumn("nat_h", F.lit(1)))


def test_a_third_of_the_rows_in_one_key(spark, dense, model):
    """Copies of one row get the features of that row, each of them."""
    one = dense.select("date", "store_nbr", "item_nbr").limit(1)
    copies = one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000))))
    out = model.transform(copies.drop("copy"))
    assert out.count() == 3000 and out.distinct().count() == 1
    assert table(out.distinct()) == table(model.transform(one))


# A small world with known answers.
ITEMS = [(1, "a", 1, 1), (2, "a", 2, 0), (3, "b", 1, 0), (4, None, 1, 0)]
STORES = [(1, "q", "p", "A", 5), (2, "r", "p", "A", 6), (3, "s", "t", "B", None)]


@pytest.fixture
def world(rows):
    day = dt.date(2020, 1, 3)  # a Friday
    return RetailTables(
        items=rows(ITEMS, "item_nbr int, family string, class int, perishable int"),
        stores=rows(STORES, "store_nbr int, city string, state string, type string, cluster int"),
        transactions=rows([(day, 1, 10.0), (dt.date(2020, 1, 4), 1, 20.0)], "date date, store_nbr int, transactions double"),
        oil=rows([(day, 50.0), (dt.date(2020, 1, 6), 60.0), (dt.date(2020, 1, 7), None)], "date date, dcoilwtico double"),
        holidays=rows([(day, "Holiday", "National", "", "n", False)], "date date, type string, locale string, locale_name string, description string, transferred boolean"),
    )


def test_known_world(rows, world):
    past = rows(
        [(dt.date(2020, 1, 3), s, i, 1.0) for s, i in ((1, 1), (1, 2), (2, 1), (9, 9))],
        "date date, store_nbr int, item_nbr int, unit_sales_log double",
    )
    model = FeatureEstimator(tables=world).fit(past)
    asked = rows(
        [
            (dt.date(2020, 1, 3), 1, 1, "Y"),
            (dt.date(2020, 1, 4), 1, 4, "no"),
            (dt.date(2020, 1, 6), 2, 2, None),
            (dt.date(2020, 1, 7), 9, 9, "1"),
        ],
        "date date, store_nbr int, item_nbr int, onpromotion string",
    )
    a, b, c, d = model.transform(asked).orderBy("date").collect()
    assert (a["dow"], a["is_weekend"], a["onpromo"], a["is_holiday_effective"]) == (4, 0, 1, 1)
    assert (a["store_freq"], a["item_freq"]) == (0.5, 0.5)
    assert (a["perishable"], a["family_freq_items"], a["class_freq_items"], a["class_freq_in_family"]) == (1, 0.5, 0.75, 0.5)
    # Three of the four rows are in known stores, all of them of type A and in state p.
    assert (a["cluster"], a["type_freq"], a["state_freq"]) == (5, 1.0, 1.0)
    assert (a["city_freq"], a["city_freq_in_state"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    # No earlier transactions that day: the store's latest roll stands in.
    assert a["transactions_roll14"] == 10.0 and a["sales_roll14"] is None
    # Saturday without a price: the mean of the latest rolls (none, 50, 55).
    assert b["oil_roll14"] == 52.5 and b["is_weekend"] == 1 and b["family_freq_items"] == 0.25
    assert c["oil_roll14"] == 50.0 and c["transactions_roll14"] == 0.0 and c["onpromo"] == 0
    assert d["oil_roll14"] == 55.0
    # Unknown store and item.
    assert (d["cluster"], d["type_freq"], d["perishable"], d["item_freq"]) == (-1, 0.0, 0, 0.25)


def test_null_categories(rows):
    freq = dict(listed(Q.value_frequency(rows([("a",), ("a",), (None,), ("b",)], "family string"), "family")))
    assert freq == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}


def test_keys_are_counted_in_one_scan(dense):
    plan = key_counts(dense)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_model_matrix(rows):
    df = rows([(float("inf"), None, 2, "x")], "a double, b double, unit_sales int, t string")
    assert numeric_features(df) == ["a", "b"]
    assert listed(align(df, ["b", "a", "zzz"])) == [(0.0, 0.0, 0.0)]
