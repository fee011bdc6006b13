import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.coerce import (
    add_target,
    as_int,
    keep_existing,
    parse_flag,
    require_columns,
    sales_column,
)
from shelfcast.sources import readers
from tests.conftest import listed


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_sales_bad_values(rows):
    raw = rows(
        [
            ("2017-13-01", "1", "2", "3.5", None),
            ("2017-08-15", "abc", "7.9", "x", None),
            ("2017-08-15 10:30:00", "4", None, "-2", "True"),
        ],
        "date string, store_nbr string, item_nbr string, unit_sales string, onpromotion string",
    )
    day = dt.date(2017, 8, 15)
    got = listed(readers.coerce_sales(raw), "store_nbr")
    assert got == [(day, 0, 7, 0.0, False), (day, 4, 0, -2.0, True)]


def test_ids_beyond_32_bits_stay_apart(rows):
    for kind, values in (("bigint", [3_000_000_000, 4_000_000_000]), ("string", ["3000000000", " 9007199254740993 "]), ("double", [3e9, 4e9])):
        raw = rows([(dt.date(2020, 1, 1), v) for v in values], f"date date, item_nbr {kind}")
        got = sorted(r["item_nbr"] for r in readers.coerce_sales(raw).collect())
        assert got == sorted(int(v) for v in values)


def test_nan_counts_as_missing(rows):
    raw = rows([(dt.date(2020, 1, 1), float("nan"))], "date date, unit_sales double")
    assert listed(readers.coerce_sales(raw)) == [(dt.date(2020, 1, 1), 0.0)]


def test_whole_number_cut(rows):
    df = rows([("3.7",), ("-3.7",), ("inf",), ("1e20",), ("",)], "n string")
    got = [r[0] for r in df.select(as_int(df, "n")).collect()]
    assert got == [3, -3, None, None, None]


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("boolean", [True, False, None], [True, False, False]),
        ("int", [2, 0, None], [True, False, False]),
        ("double", [2.0, 0.5, float("nan")], [True, False, False]),
        (
            "string",
            ["True", " yes ", "Y", "1", "t", "False", "0", "", "maybe", None],
            [True] * 5 + [False] * 5,
        ),
    ],
)
def test_flags(rows, kind, values, expected):
    df = rows([(v,) for v in values], f"f {kind}")
    assert [r[0] for r in df.select(parse_flag(df, "f")).collect()] == expected


def test_dimension_files(spark, tmp_path):
    items = readers.read_items(
        spark,
        write(tmp_path, "items.csv", "item_nbr,family,class,perishable\n1, DAIRY ,10,1\n2,,,x\n2,,,x\n"),
    )
    assert listed(items.select("item_nbr", "family", "class", "perishable"), "item_nbr") == [
        (1, "DAIRY", 10, 1),
        (2, "UNKNOWN", -1, 0),
    ]
    stores = readers.read_stores(
        spark, write(tmp_path, "stores.csv", "store_nbr,city,state,type,cluster\n1, Quito ,P,D,\n")
    )
    assert listed(stores.select("store_nbr", "city", "state", "type", "cluster")) == [
        (1, "Quito", "P", "D", -1)
    ]
    oil = readers.read_oil(spark, write(tmp_path, "oil.csv", "date,dcoilwtico\n2017-01-02,\n2017-01-03,52.5\n"))
    assert listed(oil, "date") == [(dt.date(2017, 1, 2), None), (dt.date(2017, 1, 3), 52.5)]
    trans = readers.read_transactions(
        spark, write(tmp_path, "transactions.csv", "date,store_nbr,transactions\nbad,1,x\n2017-01-03,2,7\n")
    )
    assert listed(trans, "store_nbr") == [(None, 1, 0.0), (dt.date(2017, 1, 3), 2, 7.0)]
    hol = readers.read_holidays(
        spark,
        write(
            tmp_path,
            "holidays_events.csv",
            "date,type,locale,locale_name,description,transferred\n2017-01-01,Holiday,National,, New Year ,False\n",
        ),
    )
    assert listed(hol) == [(dt.date(2017, 1, 1), "Holiday", "National", "", "New Year", False)]
    tables = readers.read_tables(spark, str(tmp_path))
    assert tables.items.count() == 2 and tables.holidays.count() == 1


def test_optional_columns_may_be_absent(rows):
    items = readers.coerce_items(rows([(1, "A")], "item_nbr int, family string"))
    assert items.columns == ["item_nbr", "family"]


def sales_file(spark, folder, days=100):
    start = dt.date(2020, 1, 1)
    data = [
        (start + dt.timedelta(days=d), s, 10 + s, d % 2 == 0, float(d)) for d in range(days) for s in (1, 2)
    ]
    path = str(folder / "sales")
    spark.createDataFrame(
        data, "date date, store_nbr int, item_nbr int, onpromotion boolean, unit_sales double"
    ).write.parquet(path)
    return path


def test_ten_weeks_keep_71_days(spark, tmp_path):
    path = sales_file(spark, tmp_path)
    sales = readers.read_sales(spark, path, weeks=10)
    assert sales.select("date").distinct().count() == 71
    assert readers.read_sales(spark, path, weeks=None).count() == 200
    assert readers.read_sales(spark, path, weeks=1, stores=[2], items=[12]).count() == 8


def test_window_ends_with_the_file_not_the_selection(spark, tmp_path):
    path = str(tmp_path / "sales")
    data = [(dt.date(2020, 1, 1), 1), (dt.date(2020, 3, 1), 2)]
    spark.createDataFrame(data, "date date, store_nbr int").write.parquet(path)
    assert readers.read_sales(spark, path, weeks=1, stores=[1]).count() == 0
    assert readers.read_sales(spark, path, weeks=1, stores=[0, 2]).count() == 1


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    path = sales_file(spark, tmp_path)
    sales = readers.read_sales(spark, path, 10, ["date", "store_nbr", "unit_sales"], stores=[2])
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2020-01-30)" in plan
    assert "store_nbr,2" in plan.split("PushedFilters")[1]
    assert "ReadSchema: struct<date:date,store_nbr:int,unit_sales:double>" in plan


def test_missing_columns_are_named(rows):
    df = rows([(1,)], "a int")
    with pytest.raises(ValueError, match="b.*c"):
        require_columns(df, ["c", "a", "b"])
    assert keep_existing(df, ["a", "z"]).columns == ["a"]


def test_sales_column_fallback(rows):
    df = rows([(1.0, 2.0)], "unit_sales double, unit_sales_clean double")
    assert sales_column(df, "unit_sales") == "unit_sales"
    assert sales_column(df, "y") == "unit_sales_clean"
    with pytest.raises(ValueError):
        sales_column(rows([(1,)], "a int"), "y")


def test_target_only_if_absent(rows):
    df = rows([(-1.0, 9.0)], "unit_sales double, unit_sales_clean double")
    got = add_target(df).select("unit_sales_clean", F.round("unit_sales_log", 6)).first()
    assert tuple(got) == (9.0, 2.302585)
