import datetime as dt

import pytest

from shelfcast.functions.coerce import add_target
from shelfcast.plans import forecast as P
from shelfcast.plans.formula import formula
from shelfcast.plans.model import TrainConfig, train
from shelfcast.sources.registry import RunRegistry
from workload import views as V

SF = "/root/testdata/sf0.001"
CONFIG = TrainConfig(total_days=90, sales_history_days=60)
COLUMNS = ["date", "store_nbr", "item_nbr", "onpromotion", "y_pred_log", "y_pred"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    registry = RunRegistry(spark, str(tmp_path_factory.mktemp("runs")))
    sales = add_target(V.dense_sales(spark, SF).filter("date >= '1998-09-01'"))
    learner = formula({"sales_roll14": 0.5, "dow": 0.1, "item_freq": 3.0}, 0.2)
    registry.publish("r1", train(sales, V.dense_tables(spark, SF), registry.run_dir("r1"), CONFIG, V.ORDER, learner=learner))
    return registry.load_latest()


def test_spans_are_of_neighbouring_days():
    day = lambda n: dt.date(2020, 1, n)
    days = [day(n) for n in (1, 2, 3, 4, 6, 7, 9)]
    assert P._spans(days, 3) == [(day(1), day(3)), (day(4), day(4)), (day(6), day(7)), (day(9), day(9))]
    assert P._spans([], 3) == []


def test_a_rerun_writes_only_what_is_missing(spark, run, tmp_path, monkeypatch):
    items, path, period = V.dense_items(spark, SF).filter("item_nbr <= 4"), str(tmp_path / "out"), ("1998-12-02", "1998-12-07")
    made, calls = P.forecast, []

    def failing(*args):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("lost")
        return made(*args)

    with monkeypatch.context() as m:
        m.setattr(P, "forecast", failing)
        with pytest.raises(RuntimeError):
            P.write_forecast(run, items, [1, 2], *period, path, days_at_once=3)
    days = [dt.date(1998, 12, n) for n in range(2, 8)]
    assert {r["date"] for r in P.read_forecast(spark, path, "r1").collect()} == set(days[:3])
    assert P.write_forecast(run, items, [1, 2], *period, path, days_at_once=3) == days[3:]
    assert P.write_forecast(run, items, [1, 2], *period, path) == []
    want = P.forecast_period(run, items, [1, 2], *period).select(*COLUMNS).collect()
    assert sorted(map(tuple, P.read_forecast(spark, path, "r1").select(*COLUMNS).collect())) == sorted(map(tuple, want))
    # another request is not taken for the same
    assert P.write_forecast(run, items, [1, 2], days[0], days[0], path, onpromotion=True) == days[:1]
    assert {r["onpromotion"] for r in P.read_forecast(spark, path, "r1").filter("date = '1998-12-02'").collect()} == {True}
