import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.operators import explore as X
from shelfcast.operators import filters as P
from tests.conftest import listed

D = dt.date
SALES = "date date, store_nbr int, item_nbr int, onpromotion boolean, unit_sales double"


@pytest.fixture
def sales(rows):
    return rows(
        [
            (D(2021, 1, 3), 1, 10, True, 5.0),
            (D(2021, 1, 3), 1, 10, False, -2.0),
            (D(2021, 1, 4), 2, 20, None, 3.0),
            (None, 2, 20, True, 100.0),
            (D(2021, 1, 6), 2, None, False, None),
        ],
        SALES,
    )


def test_kpi(sales):
    assert listed(X.kpi(sales, "count")) == [("2021-01-03 → 2021-01-06", 2, 2, 4, 4 / 3)]
    assert listed(X.kpi(sales, "units")) == [("2021-01-03 → 2021-01-06", 2, 2, 8.0, 8 / 3)]


def test_kpi_without_rows(sales):
    assert listed(X.kpi(sales.limit(0), "count")) == [("—", None, None, None, None)]
    assert listed(X.kpi(sales.limit(0), "units")) == [("—", None, None, None, None)]


def test_daily(sales):
    assert listed(X.daily_sales(sales), "date") == [
        (D(2021, 1, 3), 2),
        (D(2021, 1, 4), 1),
        (D(2021, 1, 6), 1),
    ]
    assert listed(X.daily_sales(sales, "units"), "date") == [
        (D(2021, 1, 3), 5.0),
        (D(2021, 1, 4), 3.0),
        (D(2021, 1, 6), 0.0),
    ]
    assert listed(X.daily_sales(sales, "units", clip=False), "date")[0] == (D(2021, 1, 3), 3.0)


def test_series_and_wide(sales):
    long = X.daily_by_series(sales, "pair", "unit_sales")
    assert listed(long, "date") == [(D(2021, 1, 3), "1 · 10", 3.0), (D(2021, 1, 4), "2 · 20", 3.0)]
    wide = X.daily_wide(sales, "store", "unit_sales", series=["1", "2"])
    assert wide.columns == ["date", "1", "2"]
    assert listed(wide, "date")[:2] == [(D(2021, 1, 3), 3.0, None), (D(2021, 1, 4), None, 3.0)]
    assert X.daily_wide(sales, "store", "unit_sales", series=["2"]).columns == ["date", "2"]


def test_wide_asks_for_its_series(sales):
    with pytest.raises(TypeError, match="series"):
        X.daily_wide(sales, "store", "unit_sales")


def test_outputs_come_in_order(spark):
    df = spark.range(500).selectExpr(
        "date_add(DATE'2021-01-01', cast(id * 37 % 90 as int)) AS date", "id * 7 % 50 AS store_nbr",
        "id * 11 % 80 AS item_nbr", "cast(id as double) AS unit_sales_pos", "cast(id as double) AS unit_sales",
    ).repartition(7)

    def ordered(out, *keys):
        found = [tuple(r[k] for k in keys) for r in out.collect()]
        return found == sorted(found) and len(found) > 10

    assert ordered(X.daily_sales(df), "date") and ordered(X.daily_by_series(df, "item"), "date", "series")
    assert ordered(X.daily_wide(df, "store", series=["1", "2"]), "date")
    assert ordered(X.week_heatmap(df), "iso_year", "iso_week")
    assert ordered(P.distinct_ids(df, "store_nbr"), "store_nbr") and ordered(P.search_ids(df, "item_nbr"), "item_nbr")


def test_top_groups_ties_and_direction(rows):
    df = rows([("b", 2.0), ("a", 2.0), ("c", 9.0), (None, 50.0)], "g string, unit_sales double")
    assert listed(X.top_groups(df, "g", 2, "units")) == [("c", 9.0), ("a", 2.0)]
    assert listed(X.top_groups(df, "g", 2, "units", ascending=True)) == [("a", 2.0), ("b", 2.0)]
    assert listed(X.top_groups(df, "g", 5, "count")) == [("a", 1), ("b", 1), ("c", 1)]
    with pytest.raises(ValueError, match="h"):
        X.top_groups(df, "h")
    with pytest.raises(ValueError, match="mode"):
        X.top_groups(df, "g", mode="sum")


def test_top_families_ignores_unknown_items(sales, rows):
    items = rows([(10, "A"), (30, "B")], "item_nbr int, family string")
    assert listed(X.top_families(sales, items, y_col="unit_sales")) == [("A", 5.0)]
    with_family = X.sales_with_family(sales, items)
    assert with_family.count() == 5 and with_family.filter("family IS NULL").count() == 3


def test_promo_split(sales):
    assert sorted(listed(X.promo_split(sales))) == [("Avec promo", 2), ("Sans promo", 3)]
    assert sorted(listed(X.promo_split(sales, "units"))) == [("Avec promo", 105.0), ("Sans promo", 3.0)]
    renamed = sales.withColumn("onpromo", F.col("onpromotion").cast("int")).drop("onpromotion")
    assert sorted(listed(X.promo_split(renamed))) == [("Avec promo", 2), ("Sans promo", 3)]
    with pytest.raises(ValueError):
        X.promo_split(sales.drop("onpromotion"))


def test_heatmap_at_the_turn_of_the_year(sales):
    got = {r["week_label"]: r for r in X.week_heatmap(sales).collect()}
    assert set(got) == {"2020-W53", "2021-W01"}
    assert got["2020-W53"]["Dim"] == 2 and got["2020-W53"]["Lun"] == 0
    assert (got["2021-W01"]["Lun"], got["2021-W01"]["Mer"]) == (1, 1)
    units = {r["week_label"]: r for r in X.week_heatmap(sales, "units").collect()}
    assert units["2020-W53"]["Dim"] == 5.0


def test_scalars(rows):
    got = rows([(D(2021, 1, 3), 60.0)], "d date, x double").select(
        S.weekday(F.col("d")),
        S.iso_year(F.col("d")),
        S.iso_week(F.col("d")),
        S.store_day_key(F.lit(2200), F.col("d")),
        S.units_from_log(F.col("x")) == F.expm1(F.lit(50.0)),
        S.ratio(F.lit(1), F.lit(0)),
        S.ratio(F.lit(1), F.lit(0), empty=None),
        S.finite(F.lit(float("inf"))),
        S.finite(F.lit(float("nan"))),
        S.finite(F.lit(None)),
    )
    assert listed(got) == [(6, 2020, 53, 2220210103, True, 0.0, None, 0.0, 0.0, 0.0)]


def test_reversed_range_and_membership(sales):
    a = P.select_sales(sales, "2021-01-04", "2021-01-03")
    b = P.select_sales(sales, D(2021, 1, 3), D(2021, 1, 4))
    assert sorted(map(str, listed(a))) == sorted(map(str, listed(b))) and a.count() == 3
    assert P.select_sales(sales, "2021-01-03", "2021-01-06", stores=[1], items=[]).count() == 2
    assert P.only_members(sales, "item_nbr", list(range(5000))).count() == 4
    assert P.only_members(sales, "item_nbr", None).count() == 5


def test_windows_back_from_the_latest_day(sales):
    assert P.trailing_days(sales, 3).count() == 2
    assert P.trailing_weeks(sales, 1).count() == 4
    assert P.trailing_days(sales.limit(0), 3).count() == 0


def test_id_search(rows):
    df = rows([(i,) for i in (117, 7, 27, 30, None, 7)], "item_nbr int")
    assert [r[0] for r in P.search_ids(df, "item_nbr", "7").collect()] == [7, 27, 117]
    assert [r[0] for r in P.search_ids(df, "item_nbr", limit=2).collect()] == [7, 27]


def test_daily_of_top_groups_shuffles_sales_once(sales):
    # Both stores total 3.0: the smaller number wins the tie.
    out = X.daily_of_top_groups(sales, "store_nbr", 1, "unit_sales")
    assert listed(out.select("store_nbr", "date", "unit_sales")) == [(1, D(2021, 1, 3), 3.0)]
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
