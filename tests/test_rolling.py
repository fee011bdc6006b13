import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import rolling as R
from shelfcast.operators.dedup import keep_first, keep_last
from tests.conftest import listed

D0 = dt.date(2020, 1, 1)
HIST = "store_nbr int, item_nbr int, date date, y double"
KEYS = "store_nbr int, item_nbr int, date date"


def day(n):
    return D0 + dt.timedelta(days=n)


def test_gap_of_three_uses_t4_to_t17_and_t31(rows):
    """Day t = 40 with y = 2^... values that show which days were used."""
    past = rows([(1, 1, day(i), float(i)) for i in range(40)], HIST)
    got = R.sales_lag_roll(past, rows([(1, 1, day(40))], KEYS), gap=3).first()
    assert got["sales_lag28"] == 9.0 and got["sales_lag28_avail"] == 1
    assert got["sales_roll14"] == sum(range(23, 37)) / 14
    assert got["sales_roll14_cnt"] == 14 and got["sales_roll14_frac"] == 1.0
    nogap = R.sales_lag_roll(past, rows([(1, 1, day(40))], KEYS)).first()
    assert nogap["sales_lag28"] == 12.0 and nogap["sales_roll14"] == sum(range(26, 40)) / 14


def test_no_history_gives_null_not_zero(rows):
    past = rows([(1, 1, day(0), 5.0)], HIST)
    got = R.sales_lag_roll(past, rows([(1, 1, day(90)), (2, 2, day(1))], KEYS), gap=3)
    for row in got.collect():
        assert row["sales_lag28"] is None and row["sales_roll14"] is None
        assert (row["sales_lag28_avail"], row["sales_roll14_cnt"], row["sales_roll14_frac"]) == (0, 0, 0.0)


@pytest.mark.parametrize("gap", [0, 3])
def test_against_brute_force(rows, gap):
    rnd = random.Random(gap)
    past = {(s, i, n): rnd.random() for s in (1, 2) for i in (1, 2) for n in range(60) if rnd.random() < 0.6}
    asked = [(s, i, n) for s in (1, 2, 3) for i in (1, 2) for n in range(0, 95, 2)]
    got = {
        (r["store_nbr"], r["item_nbr"], (r["date"] - D0).days): r
        for r in R.sales_lag_roll(
            rows([(s, i, day(n), y) for (s, i, n), y in past.items()], HIST),
            rows([(s, i, day(n)) for s, i, n in asked] * 2, KEYS),
            gap,
        ).collect()
    }
    assert set(got) == set(asked)
    for s, i, n in asked:
        window = [past[s, i, n - gap - j] for j in range(1, 15) if (s, i, n - gap - j) in past]
        row = got[s, i, n]
        assert row["sales_lag28"] == past.get((s, i, n - 28 - gap))
        assert row["sales_roll14_cnt"] == len(window)
        if window:
            assert row["sales_roll14"] == pytest.approx(sum(window) / len(window))
        else:
            assert row["sales_roll14"] is None


def test_a_hot_key_stays_small(spark, rows):
    """A third of the requests share one key: they reach the window as one row."""
    hot = spark.range(30_000).select(F.lit(1).alias("store_nbr"), F.lit(1).alias("item_nbr"), F.lit(day(40)).alias("date"))
    out = R.sales_lag_roll(rows([(1, 1, day(9), 7.0)], HIST), hot, gap=3)
    assert listed(out.select("sales_lag28")) == [(7.0,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")


def test_the_history_moves_once(rows):
    out = R.sales_lag_roll(rows([(1, 1, day(9), 7.0)], HIST), rows([(1, 1, day(40))], KEYS), gap=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One exchange for the window of the series, one for the distinct requests.
    assert plan.count("Exchange hashpartitioning(") == 2


def test_keep_last_and_first(rows):
    df = rows(
        [(1, 1, 10.0), (1, 2, 5.0), (1, 2, 6.0), (2, None, 1.0), (None, 9, 3.0)], "k int, o int, v double"
    )
    assert sorted(listed(keep_last(df, ["k"], ["o"])), key=str) == sorted(
        [(1, 2, 6.0), (2, None, 1.0), (None, 9, 3.0)], key=str
    )
    assert listed(keep_first(df.filter("k = 1"), ["k"], ["o"])) == [(1, 1, 10.0)]


def test_history_keeps_the_last_row_and_the_last_days(rows):
    df = rows(
        [(1, 1, day(0), 1, 9.0), (1, 1, day(10), 2, 4.0), (1, 1, day(10), 1, 8.0), (1, 1, None, 5, 1.0)],
        "store_nbr int, item_nbr int, date date, seq int, t double",
    )
    assert listed(R.sales_history(df, "t", days=9, order=["seq"])) == [(1, 1, day(10), 4.0)]
    assert R.sales_history(df, "t", days=10, order=["seq"]).count() == 2
    assert R.sales_history(df, "t", order=["seq"]).count() == 2


def test_transactions_roll_over_rows_not_days(rows):
    """Recorded days are far apart; the frame counts rows. Two rows of a day are summed."""
    data = [(day(10 * n), 1, float(n)) for n in range(6)] + [(day(0), 1, 100.0), (day(0), 2, 1.0)]
    t = rows(data, "date date, store_nbr int, transactions double")
    got = {(r["store_nbr"], r["date"]): r["transactions_roll14"] for r in R.transactions_roll(t, 1).collect()}
    assert got[1, day(0)] is None and got[1, day(10)] is None
    assert got[1, day(20)] == 100.0 and got[1, day(30)] == 50.5
    assert got[1, day(50)] == pytest.approx((100 + 1 + 2 + 3) / 4)
    last = dict(listed(R.transactions_last(R.transactions_roll(t, 1))))
    assert last == {1: got[1, day(50)]}


def test_oil(rows):
    oil = rows([(day(0), 1.0), (day(1), None), (day(2), 3.0), (day(5), 4.0)], "date date, dcoilwtico double")
    assert [r[1] for r in listed(R.oil_filled(oil), "date")] == [1.0, 1.0, 3.0, 4.0]
    rolls = R.oil_roll(oil)
    assert [r[1] for r in listed(rolls, "date")] == [None, 1.0, 1.0, pytest.approx(5 / 3)]
    assert R.oil_fallback(rolls).first()[0] == pytest.approx((1 + 1 + 5 / 3) / 3)
