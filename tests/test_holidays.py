import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import holidays as H
from tests.conftest import listed

D = dt.date
COLS = "date date, type string, locale string, locale_name string, description string, transferred boolean"
STORES = [(1, "Quito", "Pichincha"), (2, "Ambato", "Tungurahua"), (3, None, None)]


def calendar(rows):
    return rows(
        [
            (D(2017, 1, 1), "Holiday", "National", "X", "Moved", True),
            (D(2017, 1, 4), "Transfer", "National", "X", "Moved", False),
            (D(2017, 1, 9), "Transfer", "National", "X", "Moved", False),
            (D(2017, 2, 1), "Holiday", "National", "X", "No new day", True),
            (D(2017, 3, 1), "Holiday", "Local", " Quito ", "City", False),
            (D(2017, 4, 1), "Holiday", "Regional", "Tungurahua", "State", False),
            (D(2017, 5, 1), "Event", "Regional", "Tungurahua", "Not a holiday", False),
            (D(2017, 6, 1), "Holiday", "Local", "Nowhere", "No store", False),
            (None, "Holiday", "National", "X", "Undated", False),
        ],
        COLS,
    )


def test_moved_holidays(rows):
    got = dict(listed(H.national(H.observed(calendar(rows)))))
    assert got == {D(2017, 1, 4): 1, D(2017, 1, 9): 0, D(2017, 2, 1): 1}


def test_transfer_needs_the_same_place(rows):
    cal = calendar(rows).withColumn(
        "locale_name", F.when(F.col("type") == "Transfer", "Y").otherwise(F.col("locale_name"))
    )
    assert dict(listed(H.national(H.observed(cal))))[D(2017, 1, 1)] == 1


def test_regional_and_local(rows):
    stores = rows(STORES, "store_nbr int, city string, state string")
    got = {(d, s): h for d, s, h in listed(H.override(H.observed(calendar(rows)), stores))}
    assert got == {(D(2017, 3, 1), 1): 1, (D(2017, 4, 1), 2): 1, (D(2017, 5, 1), 2): 0}


def test_absent_columns(rows):
    bare = rows([(D(2017, 1, 1), "Holiday")], "date date, type string")
    row = H.observed(bare).first()
    assert row["locale"] == "" and row["f_holiday"] == 1 and row["observed_date"] == D(2017, 1, 1)
    text = rows([(D(2017, 1, 1), "Holiday", "yes"), (D(2017, 1, 2), "Transfer", None)], "date date, type string, transferred string")
    assert sorted(r["observed_date"] for r in H.observed(text).collect()) == [D(2017, 1, 2), D(2017, 1, 2)]
