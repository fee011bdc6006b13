"""Leakage-safe features: an estimator whose fitted state is a set of Parquet tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import scalars as S
from shelfcast.functions.coerce import as_date, as_id, not_null, parse_flag, require_columns
from shelfcast.operators import frequency, holidays, rolling
from shelfcast.operators.filters import INLINE_IDS
from shelfcast.operators.lookup import BROADCAST_BYTES, lookup, merge, small_enough
from shelfcast.operators.rolling import KEY
from shelfcast.session import shared_dir

TARGETS = ["unit_sales_log", "unit_sales_clean"]

CALENDAR_FEATURES = ["year", "month", "day", "dow", "is_weekend"]
STORE_FEATURES = ["cluster", "type_freq", "state_freq", "city_freq", "city_freq_in_state"]
ITEM_FEATURES = ["perishable", "family_freq_items", "class_freq_items", "class_freq_in_family"]
SALES_FEATURES = [
    "sales_lag28",
    "sales_lag28_avail",
    "sales_roll14",
    "sales_roll14_cnt",
    "sales_roll14_frac",
]
FEATURES = [
    *CALENDAR_FEATURES,
    "onpromo",
    "store_freq",
    "item_freq",
    *ITEM_FEATURES,
    *STORE_FEATURES,
    "transactions_roll14",
    "oil_roll14",
    "is_holiday_effective",
    *SALES_FEATURES,
]

# State tables and the columns each is unique on.
STATE_KEYS = {
    "store": ["store_nbr"],
    "item": ["item_nbr"],
    "store_day": ["store_nbr", "date"],
    "day": ["date"],
    "sales_hist": KEY,
}
# State columns that feed a feature under another name.
STATE_ONLY = ["last_roll", "nat_h", "h"]
LOOKUPS = ["store", "item", "store_day", "day"]


class _GapParams(Params):
    sales_history_days = Param(
        Params._dummy(), "sales_history_days", "days of sales kept for lags", TypeConverters.toInt
    )
    feature_gap_days = Param(
        Params._dummy(), "feature_gap_days", "days by which sales arrive late", TypeConverters.toInt
    )

    @property
    def gap(self):
        return self.getOrDefault(self.feature_gap_days)


def target_column(df):
    for name in TARGETS:
        if name in df.columns:
            return name
    raise ValueError(f"the history needs one of {TARGETS}: call add_target first")


def key_counts(history):
    """Rows per store and rows per item, from one scan of the history."""
    sets = [["store_nbr"], ["item_nbr"]]
    return history.groupingSets(sets, "store_nbr", "item_nbr").agg(F.count(F.lit(1)).alias("n"))


def counts_of(counts, key):
    """The part of ``key_counts`` that belongs to one key (the other key is null there)."""
    return counts.filter(F.col(key).isNotNull()).select(key, "n")


def store_state(counts, stores, rolls):
    """Everything looked up by store, in one table: one join at scoring time instead of three."""
    per_store = counts_of(counts, "store_nbr")
    return merge(
        ["store_nbr"],
        frequency.share(per_store, "store_freq"),
        frequency.store_shares(frequency.weigh_stores(stores, per_store)),
        rolling.transactions_last(rolls),
    )


def item_state(counts, items):
    freq = frequency.share(counts_of(counts, "item_nbr"), "item_freq")
    return merge(["item_nbr"], freq, frequency.item_features(items))


def store_day_state(rolls, observed_rows, stores):
    return merge(["store_nbr", "date"], rolls, holidays.override(observed_rows, stores))


def day_state(oil_rolls, observed_rows):
    return merge(["date"], oil_rolls, holidays.national(observed_rows))


def clustered(sales_hist):
    """History in series order, so that a forecast for a few series reads a few row groups.
    A series has at most one row per day, so ranges of series are of even size."""
    series = ["store_nbr", "item_nbr"]
    return sales_hist.repartitionByRange(*series).sortWithinPartitions(*KEY)


def only_series(sales_hist, series):
    """The history of a few ``series``, whose ids are pushed into the file scan as literals.

    With more of them it stays whole: rows of other series change no result, and a join with the
    history would cost more than it saves.
    """
    few = series.limit(INLINE_IDS + 1).collect()
    if len(few) > INLINE_IDS:
        return sales_hist
    for name in ("store_nbr", "item_nbr"):
        sales_hist = sales_hist.filter(F.col(name).isin(sorted({r[name] for r in few})))
    return sales_hist


def _until(df, day):
    return df if day is None else df.filter(F.col("date") <= F.lit(day))


class FeatureEstimator(Estimator, _GapParams):
    """Learns frequencies, transaction and oil rolls, holidays and the sales lookup.

    With a gap of 3 the sales mean of day t uses t-4 ... t-17 and the lag uses t-31;
    transactions are shifted by the same gap in recorded days. ``as_of`` cuts transactions,
    oil and holidays at a day; by default they are used whole. ``order`` names the columns
    that decide which of several rows with one (store, item, date) is the last.
    ``cluster_history`` writes the lag history in series order, one more shuffle, which serves
    later forecasts for a few series.
    """

    def __init__(
        self,
        *,
        tables=None,
        sales_history_days=120,
        feature_gap_days=0,
        order=(),
        as_of=None,
        state_dir=None,
        cluster_history=False,
    ):
        super().__init__()
        self._setDefault(sales_history_days=120, feature_gap_days=0)
        self._set(sales_history_days=sales_history_days, feature_gap_days=feature_gap_days)
        self.tables, self.order, self.as_of = tables, list(order), as_of
        self.state_dir, self.cluster_history = state_dir, cluster_history

    def _fit(self, history):
        spark = history.sparkSession
        target = target_column(history)
        require_columns(history, [*KEY, *self.order])
        typed = history.withColumns(
            {
                "date": as_date(history, "date"),
                "store_nbr": not_null(as_id(history, "store_nbr"), "store_nbr"),
                "item_nbr": not_null(as_id(history, "item_nbr"), "item_nbr"),
            }
        )
        days = self.getOrDefault(self.sales_history_days)
        return self._fitted(spark, rolling.sales_history(typed, target, days, self.order), key_counts(typed), target)

    def fit_daily(self, daily, first=None, last=None):
        """The fit of the rows that ``daily`` (a ``DailyState``) has added up, of all days or from
        ``first`` to ``last``, without reading the rows again."""
        days = self.getOrDefault(self.sales_history_days)
        past = rolling.trailing_history(daily.history(first, last), days)
        return self._fitted(daily.spark, past, daily.counts(first, last), daily.target)

    def _fitted(self, spark, sales_hist, counts, target):
        t, gap = self.tables, self.gap
        days = self.getOrDefault(self.sales_history_days)
        path = self.state_dir or shared_dir(spark, "features")
        # First everything that reads large tables; the other state tables are then small
        # joins over these written results.
        parts = write_tables(
            path,
            sales_hist=clustered(sales_hist) if self.cluster_history else sales_hist,
            counts=counts,
            rolls=rolling.transactions_roll(_until(t.transactions, self.as_of), gap),
            oil=rolling.oil_roll(_until(t.oil, self.as_of)),
            observed=holidays.observed(_until(t.holidays, self.as_of)),
            stores=t.stores.select(*frequency.STORE_COLUMNS),
            items=t.items.select(*frequency.ITEM_COLUMNS),
        )
        state = write_tables(
            path,
            store=store_state(parts["counts"], parts["stores"], parts["rolls"]),
            item=item_state(parts["counts"], parts["items"]),
            store_day=store_day_state(parts["rolls"], parts["observed"], parts["stores"]),
            day=day_state(parts["oil"], parts["observed"]),
        )
        state["sales_hist"] = parts["sales_hist"]
        params = {
            "target": target,
            "feature_gap_days": gap,
            "sales_history_days": days,
            "oil_fallback": rolling.oil_fallback(parts["oil"]).first()[0],
            # The sizes decide which tables are broadcast.
            **row_counts({name: state[name] for name in LOOKUPS}),
        }
        # Written last: a folder without it is not a finished state.
        rows = spark.createDataFrame([tuple(params.values())], params_schema(params))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        return FeatureModel(path, state, params)


def row_counts(tables):
    """Rows per table, in one job that reads Parquet footers only."""
    parts = [t.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n, t in tables.items()]
    return {f"n_{r['name']}": r["n"] for r in reduce(DataFrame.unionByName, parts).collect()}


def params_schema(names):
    kinds = {"target": "string", "oil_fallback": "double"}
    return ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in names)


def write_tables(path, **tables):
    """Writes independent tables at the same time and returns them as read back."""
    spark = next(iter(tables.values())).sparkSession

    def write(name):
        tables[name].write.mode("overwrite").parquet(f"{path}/{name}")

    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), tables))
    return {n: spark.read.schema(t.schema).parquet(f"{path}/{n}") for n, t in tables.items()}


class FeatureModel(Model, _GapParams):
    """Adds the 25 feature columns to rows with date, store_nbr, item_nbr and, optionally,
    onpromotion. Lag and mean stay null where there is no history."""

    def __init__(self, path, tables, params):
        super().__init__()
        self._setDefault(sales_history_days=120, feature_gap_days=0)
        self._set(
            sales_history_days=params["sales_history_days"],
            feature_gap_days=params["feature_gap_days"],
        )
        self.path, self.tables = path, tables
        self.n_rows = {name: params[f"n_{name}"] for name in LOOKUPS}
        self.target, self.oil_fallback = params["target"], params["oil_fallback"]
        self.broadcast_bytes = BROADCAST_BYTES

    @classmethod
    def load(cls, spark, path):
        params = spark.read.parquet(f"{path}/params").first().asDict()
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in STATE_KEYS}
        return cls(path, tables, params)

    def save(self, path):
        """Copies the state; the params come last, as in fit."""
        spark = self.tables["day"].sparkSession
        write_tables(path, **self.tables)
        spark.read.parquet(f"{self.path}/params").write.mode("overwrite").parquet(f"{path}/params")

    def _lookup(self, out, name, rows):
        """Joins one state table. A dated table too large to broadcast is first cut to the days
        of ``rows``: usually a few weeks out of years, which then can be broadcast after all."""
        table, n, keys = self.tables[name], self.n_rows[name], STATE_KEYS[name]
        if "date" in keys and not small_enough(table, n, self.broadcast_bytes):
            first, last = rows.agg(F.min("date"), F.max("date")).first()
            if first is not None:
                table = table.filter(F.col("date").between(F.lit(first), F.lit(last)))
                n = table.count()
        return lookup(out, table, keys, n, self.broadcast_bytes)

    def sales_features(self, rows, series=None):
        """Lag and mean per distinct key of ``rows``. ``series`` holds the (store_nbr, item_nbr)
        of ``rows``, where the caller has them at hand; the history is cut to them if they are few."""
        past = self.tables["sales_hist"]
        if series is not None:
            past = only_series(past, series)
        return rolling.sales_lag_roll(past, rows, self.gap)

    def _transform(self, dataset):
        return self.enrich(dataset)

    def enrich(self, rows, series=None):
        require_columns(rows, KEY)
        clash = sorted({*FEATURES, *STATE_ONLY} & set(rows.columns))
        if clash:
            raise ValueError(f"input already has feature columns: {clash}")
        promo = parse_flag(rows, "onpromotion") if "onpromotion" in rows.columns else F.lit(False)
        typed = rows.withColumns(
            {
                "date": not_null(as_date(rows, "date"), "date"),
                "store_nbr": not_null(as_id(rows, "store_nbr"), "store_nbr"),
                "item_nbr": not_null(as_id(rows, "item_nbr"), "item_nbr"),
            }
        )
        # The one shuffle of the rows comes first, while they are narrow; the rest is
        # broadcast lookups for as long as the state tables stay small.
        out = typed.withColumn("onpromo", promo.cast("int"))
        out = out.join(self.sales_features(typed, series), KEY, "left")
        for name in LOOKUPS:
            out = self._lookup(out, name, typed)

        def known(name, default=0.0):
            return F.coalesce(F.col(name), F.lit(default))

        holiday = F.greatest(known("nat_h", 0), known("h", 0))
        features = {
            **S.calendar_columns(F.col("date")),
            "onpromo": F.col("onpromo"),
            "store_freq": known("store_freq"),
            "item_freq": known("item_freq"),
            "perishable": known("perishable", 0),
            **{c: known(c) for c in ITEM_FEATURES if c != "perishable"},
            "cluster": known("cluster", -1),
            **{c: known(c) for c in STORE_FEATURES if c != "cluster"},
            "transactions_roll14": F.coalesce("transactions_roll14", "last_roll", F.lit(0.0)),
            "oil_roll14": F.coalesce(F.col("oil_roll14"), F.lit(self.oil_fallback).cast("double")),
            "is_holiday_effective": holiday,
            **{c: F.col(c) for c in SALES_FEATURES},
        }
        return out.select(*rows.columns, *[features[name].alias(name) for name in FEATURES])
