"""Every operator as a query over the generated tables, paired with its SQL where SQL can
express it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import scalars as S
from shelfcast.functions.coerce import add_target, keep_existing, positive
from shelfcast.operators import explore as X
from shelfcast.operators import filters as P
from shelfcast.operators import frequency as Q
from shelfcast.operators import holidays as H
from shelfcast.operators import rolling as R
from shelfcast.operators.dedup import keep_first, keep_last
from shelfcast.operators.lookup import lookup
from shelfcast.operators.metrics import regression_metrics, worst_errors
from shelfcast.operators.sampling import exact_sample
from shelfcast.operators.split import fit_sizes_to, fitted_sizes, label_split, split_info, time_split
from shelfcast.plans import features as M
from shelfcast.plans.daily import DailyState
from shelfcast.plans.evaluate import evaluate
from shelfcast.plans.forecast import forecast_grid, forecast_period, forecast_point
from shelfcast.plans.formula import formula
from shelfcast.plans.jobs import build_now, run_if_new
from shelfcast.plans.model import MODEL_FEATURES, TrainConfig, align, numeric_features, score, train
from shelfcast.session import shared_dir
from shelfcast.sources import readers
from shelfcast.sources.artifacts import export_csv, load_metadata, read_json
from shelfcast.sources.dated import write_dated
from shelfcast.sources.fingerprint import FileHashes, content_fingerprint, row_hash_sum, total_signature
from shelfcast.sources.registry import RunRegistry
from workload import sql as W
from workload import views as V

QUERIES = {}
ORACLES = {}

GAP = 3
# Longer than the tables: the whole history serves lags and training.
ALL_DAYS = 36_500
ROW_ID = ["date", "store_nbr", "item_nbr", "l_orderkey", "l_linenumber", "unit_sales"]


def query(name, sql=None, extra=""):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = W.with_views(sql, extra)
        return fn

    return register


# Doubles of a table from which on they are rounded as one array: one generated method for all of
# them together with the joins below is longer than the JVM compiles, and every row then runs interpreted.
WIDE = 12


def rounded(df, digits=6):
    """Floating results to a fixed number of decimals, so that two engines can be compared."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]

    def cut(value):
        return F.round(value, digits) + F.lit(0.0)

    if len(doubles) < WIDE:
        return df.select(*[cut(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])
    others = [c for c in df.columns if c not in doubles]
    at = {c: F.col("_rounded")[i].alias(c) for i, c in enumerate(doubles)}
    return df.select(*others, F.transform(F.array(*doubles), cut).alias("_rounded")).select(*[at.get(c, F.col(c)) for c in df.columns])


def r6(*names):
    return ", ".join(f"round({n}, 6) + 0.0 AS {n.split('.')[-1]}" for n in names)


def natural(spark, sf_dir):
    """Natural-grain sales with positive units."""
    return V.natural_sales(spark, sf_dir).withColumn("unit_sales_pos", positive(F.col("unit_sales")))


def dense(spark, sf_dir):
    return V.dense_sales(spark, sf_dir).withColumn("unit_sales_pos", positive(F.col("unit_sales")))


# ---------------------------------------------------------------- sources


@query(
    "sales_scan",
    """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS BIGINT) AS store_nbr,
       CAST(l_partkey AS BIGINT) AS item_nbr, l_quantity AS unit_sales FROM lineitem
       WHERE CAST(l_shipdate AS DATE) >= (SELECT max(CAST(l_shipdate AS DATE)) - 70 FROM lineitem)""",
)
def sales_scan(spark, sf_dir):
    return readers.read_sales(
        spark,
        f"{sf_dir}/lineitem.parquet",
        weeks=10,
        columns=["date", "store_nbr", "item_nbr", "unit_sales"],
        rename=V.SALES_RENAME,
    )


@query("items_load", "SELECT * FROM v_items")
def items_load(spark, sf_dir):
    return readers.coerce_items(V.natural_items(spark, sf_dir))


@query("stores_load", "SELECT * FROM v_stores")
def stores_load(spark, sf_dir):
    return readers.coerce_stores(V.natural_stores(spark, sf_dir))


@query("oil_load", "SELECT * FROM d_oil")
def oil_load(spark, sf_dir):
    return readers.coerce_oil(V.dense_oil(spark, sf_dir))


@query("transactions_load", "SELECT * FROM d_transactions")
def transactions_load(spark, sf_dir):
    return readers.coerce_transactions(V.dense_transactions(spark, sf_dir))


@query("holidays_load", "SELECT * FROM d_holidays")
def holidays_load(spark, sf_dir):
    return readers.coerce_holidays(V.dense_holidays(spark, sf_dir))


@query(
    "source_fingerprint",
    """SELECT count(*) AS n_rows, true AS same_when_reordered, true AS differs_when_doubled,
       true AS differs_when_changed FROM lineitem""",
)
def source_fingerprint(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    def mark(df):
        return row_hash_sum(df).select(F.concat_ws(":", "n_rows", "hash_sum")).scalar()

    third = F.col("l_orderkey") % 3 == 0
    changed = rows.withColumn("l_quantity", F.when(third, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    base = row_hash_sum(rows).select("n_rows", F.concat_ws(":", "n_rows", "hash_sum").alias("mark"))
    return base.select(
        "n_rows",
        (F.col("mark") == mark(rows.repartition(*rows.columns))).alias("same_when_reordered"),
        (F.col("mark") != mark(rows.union(rows.filter(third)))).alias("differs_when_doubled"),
        (F.col("mark") != mark(changed)).alias("differs_when_changed"),
    )


# Text as a careless export leaves it: unreadable days, numbers and flags, ids beyond 32 bits.
_DIRTY = """SELECT CASE WHEN l_linenumber % 5 = 0 THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) AS {text}) END AS date,
    CASE WHEN l_orderkey % 11 = 0 THEN 'x' ELSE concat(CAST(l_suppkey AS {text}), '.7') END AS store_nbr,
    CAST(l_partkey + 3000000000 AS {text}) AS item_nbr,
    CASE WHEN l_orderkey % 7 = 0 THEN '?' ELSE CAST(CAST(l_quantity AS INT) AS {text}) END AS unit_sales,
    CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 'True' WHEN 1 THEN ' yes ' WHEN 2 THEN 'Y' WHEN 3 THEN 'False'
        WHEN 4 THEN '' END AS onpromotion, l_orderkey, l_linenumber"""
_CLEANED = """SELECT CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE CAST(l_suppkey AS BIGINT) END AS store_nbr,
    CAST(l_partkey + 3000000000 AS BIGINT) AS item_nbr,
    CASE WHEN l_orderkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS unit_sales,
    l_partkey % 6 < 3 AS onpromotion, l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber % 5 <> 0"""


def _dirty_sales(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr(*_columns(_DIRTY.format(text="STRING")))


def _columns(select):
    """The expressions of a SELECT list, cut at commas outside brackets."""
    out, depth, at = [], 0, 0
    body = select.removeprefix("SELECT ")
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(body[at:i])
            at = i + 1
    return [*out, body[at:]]


@query("dirty_sales", _CLEANED)
def dirty_sales(spark, sf_dir):
    return readers.coerce_sales(_dirty_sales(spark, sf_dir))


@query(
    "wide_id_frequency",
    """SELECT item_nbr, round(count(*) * 1.0 / (SELECT count(*) FROM cleaned), 6) + 0.0 AS freq
       FROM cleaned GROUP BY item_nbr""",
    f", cleaned AS ({_CLEANED})",
)
def wide_id_frequency(spark, sf_dir):
    return rounded(Q.value_frequency(readers.coerce_sales(_dirty_sales(spark, sf_dir)), "item_nbr"))


def _as_csv(df):
    """A CSV copy, as the exporter writes it."""
    path = shared_dir(df.sparkSession, "csv")
    export_csv(df, path)
    return path


@query("items_csv", "SELECT * FROM v_items")
def items_csv(spark, sf_dir):
    return readers.read_items(spark, _as_csv(V.natural_items(spark, sf_dir)))


@query("stores_csv", "SELECT * FROM v_stores")
def stores_csv(spark, sf_dir):
    return readers.read_stores(spark, _as_csv(V.natural_stores(spark, sf_dir)))


@query("oil_csv", "SELECT * FROM d_oil")
def oil_csv(spark, sf_dir):
    return readers.read_oil(spark, _as_csv(V.dense_oil(spark, sf_dir)))


@query("transactions_csv", "SELECT * FROM d_transactions")
def transactions_csv(spark, sf_dir):
    return readers.read_transactions(spark, _as_csv(V.dense_transactions(spark, sf_dir)))


@query("holidays_csv", "SELECT * FROM d_holidays")
def holidays_csv(spark, sf_dir):
    return readers.read_holidays(spark, _as_csv(V.dense_holidays(spark, sf_dir)))


@query(
    "numeric_inputs",
    """SELECT sum(CAST(item_nbr AS DOUBLE)) AS item_nbr, sum(CAST(l_linenumber AS DOUBLE)) AS l_linenumber,
       sum(CAST(l_orderkey AS DOUBLE)) AS l_orderkey, sum(CAST(store_nbr AS DOUBLE)) AS store_nbr FROM v_sales""",
)
def numeric_inputs(spark, sf_dir):
    """The columns a model may take from a table, found by type; their sums as doubles."""
    sales = V.natural_sales(spark, sf_dir)
    return sales.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in numeric_features(sales)])


@query(
    "daily_units_fallback",
    "SELECT date, sum(unit_sales_pos) AS unit_sales_pos FROM v_pos GROUP BY date",
)
def daily_units_fallback(spark, sf_dir):
    """A sales column that the table lacks is replaced by a known one."""
    return X.daily_sales(natural(spark, sf_dir).drop("unit_sales"), "units", y_col="not_there")


# ---------------------------------------------------------------- filters


@query("column_projection", "SELECT date, store_nbr, item_nbr, onpromotion, unit_sales FROM v_sales")
def column_projection(spark, sf_dir):
    wanted = [*readers.SALES_COLUMNS, "not_in_the_file"]
    return keep_existing(V.natural_sales(spark, sf_dir), wanted)


@query("positive_units", f"SELECT {', '.join(ROW_ID)}, unit_sales_pos FROM v_pos")
def positive_units(spark, sf_dir):
    return natural(spark, sf_dir).select(*ROW_ID, "unit_sales_pos")


@query(
    "target_log1p",
    f"""SELECT {', '.join(ROW_ID)}, unit_sales_pos AS unit_sales_clean,
        round(ln(1 + unit_sales_pos), 6) + 0.0 AS unit_sales_log FROM v_pos""",
)
def target_log1p(spark, sf_dir):
    sales = add_target(V.natural_sales(spark, sf_dir).select(*ROW_ID))
    return rounded(sales)


@query("recent_window", "SELECT * FROM v_sales WHERE date >= (SELECT max(date) - 70 FROM v_sales)")
def recent_window(spark, sf_dir):
    return P.trailing_weeks(V.natural_sales(spark, sf_dir), 10)


@query("last_days_window", "SELECT * FROM v_sales WHERE date >= (SELECT max(date) - 13 FROM v_sales)")
def last_days_window(spark, sf_dir):
    return P.trailing_days(V.natural_sales(spark, sf_dir), 14)


@query(
    "dated_recent",
    """
    SELECT v_sales.* REPLACE (CASE WHEN date >= d - 13 THEN 2 * unit_sales ELSE unit_sales END AS unit_sales)
    FROM v_sales CROSS JOIN (SELECT max(date) AS d FROM v_sales) WHERE date >= d - 70
    """,
)
def dated_recent(spark, sf_dir):
    """Stored by day, the last two weeks then rewritten; the last ten weeks are read back."""
    path = shared_dir(spark, "dated")
    sales = V.natural_sales(spark, sf_dir)
    write_dated(sales, path)
    write_dated(P.trailing_days(sales, 14).withColumn("unit_sales", 2 * F.col("unit_sales")), path)
    return readers.read_sales(spark, path, weeks=10)


@query(
    "date_range_filter",
    "SELECT * FROM v_pos WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'",
)
def date_range_filter(spark, sf_dir):
    # Ends given the wrong way round, as a user may.
    return P.select_sales(V.natural_sales(spark, sf_dir), "1998-12-31", "1996-01-01")


@query(
    "selected_stores",
    "SELECT * FROM v_sales WHERE store_nbr IN (SELECT store_nbr FROM v_stores WHERE state = 'ASIA')",
)
def selected_stores(spark, sf_dir):
    asia = V.natural_stores(spark, sf_dir).filter("state = 'ASIA'").select("store_nbr")
    return P.only_members(V.natural_sales(spark, sf_dir), "store_nbr", asia)


@query("store_list", "SELECT DISTINCT store_nbr FROM v_sales")
def store_list(spark, sf_dir):
    return P.distinct_ids(V.natural_sales(spark, sf_dir), "store_nbr")


@query(
    "item_search",
    """SELECT DISTINCT item_nbr FROM v_sales WHERE contains(CAST(item_nbr AS VARCHAR), '7')
       ORDER BY item_nbr""",
)
def item_search(spark, sf_dir):
    return P.search_ids(V.natural_sales(spark, sf_dir), "item_nbr", " 7 ")


@query(
    "preview_rows",
    f"SELECT {', '.join(ROW_ID)} FROM v_sales ORDER BY {', '.join(ROW_ID)} LIMIT 50",
)
def preview_rows(spark, sf_dir):
    return P.preview(V.natural_sales(spark, sf_dir).select(*ROW_ID), ROW_ID)


@query(
    "dedup_keep_last",
    "SELECT store_nbr, item_nbr, date, unit_sales, l_orderkey, l_linenumber FROM d_last",
)
def dedup_keep_last(spark, sf_dir):
    cols = ["store_nbr", "item_nbr", "date", "unit_sales", "l_orderkey", "l_linenumber"]
    return keep_last(V.dense_sales(spark, sf_dir).select(*cols), R.KEY, V.ORDER)


@query(
    "dedup_keep_first",
    """SELECT item_nbr, family, class FROM (SELECT p_size AS item_nbr, p_type AS family,
       CAST(substr(p_brand, 7) AS INT) AS class, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS rn
       FROM part) q WHERE rn = 1""",
)
def dedup_keep_first(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_size").alias("item_nbr"),
        F.col("p_type").alias("family"),
        F.substring("p_brand", 7, 100).cast("int").alias("class"),
        "p_partkey",
    )
    return keep_first(part, ["item_nbr"], ["p_partkey"]).drop("p_partkey")


# ---------------------------------------------------------------- exploration


@query(
    "date_bounds",
    """SELECT min(date) AS min_date, max(date) AS max_date,
       CAST(max(date) - min(date) + 1 AS INT) AS n_days FROM v_sales""",
)
def date_bounds(spark, sf_dir):
    return P.bounds(V.natural_sales(spark, sf_dir))


@query(
    "active_counts",
    "SELECT count(DISTINCT store_nbr) AS n_stores, count(DISTINCT item_nbr) AS n_items FROM v_sales",
)
def active_counts(spark, sf_dir):
    return X.active_counts(V.natural_sales(spark, sf_dir))


def _kpi_sql(total):
    return f"""SELECT concat(CAST(min(date) AS VARCHAR), ' → ', CAST(max(date) AS VARCHAR)) AS period,
        count(DISTINCT store_nbr) AS n_stores, count(DISTINCT item_nbr) AS n_items, {total} AS total,
        round({total} * 1.0 / count(DISTINCT date), 6) + 0.0 AS mean_per_day FROM v_pos"""


@query("kpi_count", _kpi_sql("count(*)"))
def kpi_count(spark, sf_dir):
    return rounded(X.kpi(natural(spark, sf_dir), "count"))


@query("kpi_units", _kpi_sql("sum(unit_sales_pos)"))
def kpi_units(spark, sf_dir):
    return rounded(X.kpi(natural(spark, sf_dir), "units"))


@query("daily_count", "SELECT date, count(*) AS n_obs FROM v_sales GROUP BY date")
def daily_count(spark, sf_dir):
    return X.daily_sales(V.natural_sales(spark, sf_dir), "count")


@query("daily_units", "SELECT date, sum(unit_sales_pos) AS unit_sales FROM v_pos GROUP BY date")
def daily_units(spark, sf_dir):
    return X.daily_sales(V.natural_sales(spark, sf_dir), "units")


@query("daily_units_raw", "SELECT date, sum(unit_sales) AS unit_sales FROM v_sales GROUP BY date")
def daily_units_raw(spark, sf_dir):
    return X.daily_sales(V.natural_sales(spark, sf_dir), "units", clip=False)


@query(
    "daily_by_pair",
    """SELECT date, concat(store_nbr, ' · ', item_nbr) AS series, sum(unit_sales_pos) AS value
       FROM v_pos GROUP BY date, store_nbr, item_nbr""",
)
def daily_by_pair(spark, sf_dir):
    return X.daily_by_series(natural(spark, sf_dir), "pair")


@query(
    "daily_by_item",
    """SELECT date, CAST(item_nbr AS VARCHAR) AS series, sum(unit_sales_pos) AS value
       FROM v_pos GROUP BY date, item_nbr""",
)
def daily_by_item(spark, sf_dir):
    return X.daily_by_series(natural(spark, sf_dir), "item")


@query(
    "daily_by_store",
    """SELECT date, CAST(store_nbr AS VARCHAR) AS series, sum(unit_sales_pos) AS value
       FROM v_pos GROUP BY date, store_nbr""",
)
def daily_by_store(spark, sf_dir):
    return X.daily_by_series(natural(spark, sf_dir), "store")


@query(
    "daily_wide",
    "SELECT date, "
    + ", ".join(f'sum(CASE WHEN store_nbr = {k} THEN unit_sales_pos END) AS "{k}"' for k in range(25))
    + " FROM d_pos GROUP BY date",
)
def daily_wide(spark, sf_dir):
    return X.daily_wide(dense(spark, sf_dir), "store", series=map(str, range(25)))


@query(
    "daily_per_item",
    "SELECT date, item_nbr, sum(unit_sales_pos) AS unit_sales_pos FROM d_pos GROUP BY date, item_nbr",
)
def daily_per_item(spark, sf_dir):
    return X.daily_by_group(dense(spark, sf_dir), "item_nbr")


_TOP8 = """(SELECT {key} FROM v_pos GROUP BY {key} ORDER BY sum(unit_sales_pos) DESC, {key} LIMIT 8)"""


@query(
    "daily_top_groups",
    f"""SELECT item_nbr, date, sum(unit_sales_pos) AS unit_sales_pos FROM v_pos
        WHERE item_nbr IN {_TOP8.format(key='item_nbr')} GROUP BY item_nbr, date""",
)
def daily_top_groups(spark, sf_dir):
    return X.daily_of_top_groups(natural(spark, sf_dir), "item_nbr", 8)


@query(
    "top_group_rows",
    f"""SELECT {', '.join(ROW_ID)} FROM v_pos WHERE store_nbr IN {_TOP8.format(key='store_nbr')}""",
)
def top_group_rows(spark, sf_dir):
    return X.rows_of_top_groups(natural(spark, sf_dir), "store_nbr", 8).select(*ROW_ID)


@query(
    "sales_with_family",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)}, family FROM v_sales s
        LEFT JOIN v_items i ON i.item_nbr = s.item_nbr""",
)
def sales_with_family(spark, sf_dir):
    sales = V.natural_sales(spark, sf_dir).select(*ROW_ID)
    return X.sales_with_family(sales, V.natural_items(spark, sf_dir))


def _family_sql(total, name):
    return f"""SELECT family, {total} AS {name} FROM v_pos JOIN v_items USING (item_nbr)
        GROUP BY family ORDER BY {name} DESC, family LIMIT 10"""


@query("top_families_units", _family_sql("sum(unit_sales_pos)", "unit_sales_pos"))
def top_families_units(spark, sf_dir):
    return X.top_families(natural(spark, sf_dir), V.natural_items(spark, sf_dir), 10, "units")


@query("top_families_count", _family_sql("count(*)", "n_obs"))
def top_families_count(spark, sf_dir):
    return X.top_families(natural(spark, sf_dir), V.natural_items(spark, sf_dir), 10, "count")


@query(
    "top_n_table",
    """SELECT item_nbr, sum(unit_sales_pos) AS unit_sales FROM v_pos GROUP BY item_nbr
       ORDER BY unit_sales DESC, item_nbr LIMIT 10""",
)
def top_n_table(spark, sf_dir):
    return X.top_groups(V.natural_sales(spark, sf_dir), "item_nbr", 10, "units")


@query(
    "bottom_n_table",
    "SELECT item_nbr, count(*) AS n_obs FROM v_sales GROUP BY item_nbr ORDER BY n_obs, item_nbr LIMIT 10",
)
def bottom_n_table(spark, sf_dir):
    return X.top_groups(V.natural_sales(spark, sf_dir), "item_nbr", 10, "count", ascending=True)


_PROMO = "CASE WHEN onpromotion THEN 'Avec promo' ELSE 'Sans promo' END"


@query("promo_split_count", f"SELECT {_PROMO} AS promo, count(*) AS n_obs FROM v_sales GROUP BY 1")
def promo_split_count(spark, sf_dir):
    return X.promo_split(V.natural_sales(spark, sf_dir), "count")


@query(
    "promo_split_units",
    f"SELECT {_PROMO} AS promo, sum(unit_sales_pos) AS unit_sales FROM v_pos GROUP BY 1",
)
def promo_split_units(spark, sf_dir):
    return X.promo_split(V.natural_sales(spark, sf_dir), "units")


def _heatmap_sql(value):
    cells = ", ".join(
        f"coalesce(sum(CASE WHEN isodow(date) = {i + 1} THEN {value} END), 0) AS {label}"
        for i, label in enumerate(X.WEEKDAY_LABELS)
    )
    if value == "1":
        cells = cells.replace("coalesce(", "CAST(coalesce(").replace(", 0)", ", 0) AS BIGINT)")
    return f"""SELECT CAST(isoyear(date) AS INT) AS iso_year, CAST(weekofyear(date) AS INT) AS iso_week, {cells},
        concat(isoyear(date), '-W', lpad(CAST(weekofyear(date) AS VARCHAR), 2, '0')) AS week_label
        FROM v_pos GROUP BY isoyear(date), weekofyear(date)"""


@query("heatmap_count", _heatmap_sql("1"))
def heatmap_count(spark, sf_dir):
    return X.week_heatmap(V.natural_sales(spark, sf_dir), "count")


@query("heatmap_units", _heatmap_sql("unit_sales_pos"))
def heatmap_units(spark, sf_dir):
    return X.week_heatmap(V.natural_sales(spark, sf_dir), "units")


# ---------------------------------------------------------------- scalars


@query(
    "calendar_features",
    """SELECT DISTINCT date, CAST(extract(year FROM date) AS INT) AS year,
       CAST(extract(month FROM date) AS INT) AS month, CAST(extract(day FROM date) AS INT) AS day,
       CAST(isodow(date) - 1 AS INT) AS dow, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CAST(isoyear(date) AS INT) AS iso_year, CAST(weekofyear(date) AS INT) AS iso_week,
       concat(isoyear(date), '-W', lpad(CAST(weekofyear(date) AS VARCHAR), 2, '0')) AS week_label,
       CAST(date - DATE '1970-01-01' AS INT) AS day_no FROM v_sales""",
)
def calendar_features(spark, sf_dir):
    day = F.col("date")
    days = V.natural_sales(spark, sf_dir).select("date").distinct()
    return days.withColumns(
        {
            **S.calendar_columns(day),
            "iso_year": S.iso_year(day),
            "iso_week": S.iso_week(day),
            "week_label": S.week_label(S.iso_year(day), S.iso_week(day)),
            "day_no": S.day_number(day),
        }
    )


@query(
    "store_day_keys",
    """SELECT DISTINCT store_nbr, date, CAST(store_nbr AS BIGINT) * 1000000
       + CAST(strftime(date, '%Y%m%d') AS BIGINT) AS key FROM v_sales""",
)
def store_day_keys(spark, sf_dir):
    pairs = V.natural_sales(spark, sf_dir).select("store_nbr", "date").distinct()
    return pairs.withColumn("key", S.store_day_key(F.col("store_nbr"), F.col("date")))


@query(
    "log_units",
    f"""SELECT {', '.join(ROW_ID)},
        round(ln(2 + exp(least(greatest(unit_sales, -50), 50)) - 1), 6) + 0.0 AS back,
        round(exp(ln(1 + unit_sales_pos)) - 1, 6) + 0.0 AS roundtrip FROM v_pos""",
)
def log_units(spark, sf_dir):
    rows = natural(spark, sf_dir)
    return rounded(
        rows.select(
            *ROW_ID,
            # The raw inverse spans 22 digits; its log is compared.
            F.log(2 + S.units_from_log(F.col("unit_sales"))).alias("back"),
            S.units_from_log(F.log1p("unit_sales_pos")).alias("roundtrip"),
        )
    )


# ---------------------------------------------------------------- split


_AGE = "(SELECT max(date) FROM v_sales) - date"
_LABELLED = f"""SELECT *, CASE WHEN {_AGE} <= 13 THEN 'test' WHEN {_AGE} <= 16 THEN 'gap'
    ELSE 'train' END AS split FROM v_sales WHERE {_AGE} <= 83"""


@query("split_label", _LABELLED)
def split_label(spark, sf_dir):
    return label_split(V.natural_sales(spark, sf_dir))


@query(
    "split_info",
    f"""SELECT split, min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows
        FROM ({_LABELLED}) q GROUP BY split""",
)
def split_report(spark, sf_dir):
    return split_info(label_split(V.natural_sales(spark, sf_dir)))


@query(
    "split_parts",
    f"""SELECT split, store_nbr, count(*) AS n_rows, sum(unit_sales) AS units
        FROM ({_LABELLED}) q GROUP BY split, store_nbr""",
)
def split_parts(spark, sf_dir):
    parts = time_split(V.natural_sales(spark, sf_dir))
    train_rows, gap_rows, test_rows = (
        part.withColumn("split", F.lit(name)) for part, name in zip(parts, ["train", "gap", "test"])
    )
    return (
        train_rows.unionByName(gap_rows)
        .unionByName(test_rows)
        .groupBy("split", "store_nbr")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("unit_sales").alias("units"))
    )


@query(
    "split_sizes",
    """SELECT total, test, CAST(least(3, greatest(0, (total - test) // 10)) AS INT) AS gap FROM (
         SELECT total, CAST(least(14, greatest(7, total // 6)) AS INT) AS test FROM (
           SELECT CAST(least(84, max(date) - min(date) + 1) AS INT) AS total FROM v_sales
           WHERE date >= (SELECT max(date) - 70 FROM v_sales)) a) b""",
)
def split_sizes(spark, sf_dir):
    return fitted_sizes(P.trailing_weeks(V.natural_sales(spark, sf_dir), 10)).drop("latest")


# ---------------------------------------------------------------- frequencies


def _freq_sql(key, source):
    return f"""SELECT {key}, round(count(*) * 1.0 / (SELECT count(*) FROM {source}), 6) + 0.0 AS freq
        FROM {source} GROUP BY {key}"""


@query("freq_store", _freq_sql("store_nbr", "v_sales"))
def freq_store(spark, sf_dir):
    return rounded(Q.value_frequency(V.natural_sales(spark, sf_dir), "store_nbr"))


@query("freq_item", _freq_sql("item_nbr", "v_sales"))
def freq_item(spark, sf_dir):
    return rounded(Q.value_frequency(V.natural_sales(spark, sf_dir), "item_nbr"))


@query("freq_family", _freq_sql("family", "v_items"))
def freq_family(spark, sf_dir):
    return rounded(Q.value_frequency(V.natural_items(spark, sf_dir), "family"))


@query("freq_class", _freq_sql("class", "v_items"))
def freq_class(spark, sf_dir):
    return rounded(Q.value_frequency(V.natural_items(spark, sf_dir), "class"))


@query(
    "items_fe",
    "SELECT item_nbr, perishable, "
    + r6("family_freq_items", "class_freq_items", "class_freq_in_family")
    + f" FROM ({W.item_features('v_items')}) q",
)
def items_fe(spark, sf_dir):
    return rounded(Q.item_features(V.natural_items(spark, sf_dir)))


@query(
    "store_observations",
    """SELECT s.store_nbr, s.type, s.state, s.city, s.cluster, count(h.date) AS n
       FROM v_stores s LEFT JOIN v_sales h ON h.store_nbr = s.store_nbr GROUP BY ALL""",
)
def store_observations(spark, sf_dir):
    return Q.store_weights(V.natural_sales(spark, sf_dir), V.natural_stores(spark, sf_dir))


@query(
    "store_fe",
    "SELECT store_nbr, cluster, "
    + r6("type_freq", "state_freq", "city_freq", "city_freq_in_state")
    + f" FROM ({W.store_features('v_sales', 'v_stores')}) q",
)
def store_fe(spark, sf_dir):
    return rounded(Q.store_features(V.natural_sales(spark, sf_dir), V.natural_stores(spark, sf_dir)))


# ---------------------------------------------------------------- rolls


@query("trans_daily", "SELECT store_nbr, date, transactions FROM d_trans_day")
def trans_daily(spark, sf_dir):
    return R.transactions_daily(V.dense_transactions(spark, sf_dir))


@query("trans_roll", f"SELECT store_nbr, date, {r6('transactions_roll14')} FROM ({W.trans_roll(GAP)}) q")
def trans_roll(spark, sf_dir):
    return rounded(R.transactions_roll(V.dense_transactions(spark, sf_dir), GAP))


@query(
    "trans_last",
    f"""SELECT store_nbr, round(max_by(transactions_roll14, date), 6) + 0.0 AS last_roll
        FROM ({W.trans_roll(GAP)}) q WHERE transactions_roll14 IS NOT NULL GROUP BY store_nbr""",
)
def trans_last(spark, sf_dir):
    rolls = R.transactions_roll(V.dense_transactions(spark, sf_dir), GAP)
    return rounded(R.transactions_last(rolls))


@query("oil_filled", f"SELECT date, {r6('dcoilwtico')} FROM d_oil_filled")
def oil_filled(spark, sf_dir):
    return rounded(R.oil_filled(V.dense_oil(spark, sf_dir)))


@query("oil_roll", f"SELECT date, {r6('oil_roll14')} FROM d_oil_roll")
def oil_roll(spark, sf_dir):
    return rounded(R.oil_roll(V.dense_oil(spark, sf_dir)))


@query("oil_fallback", f"SELECT {r6('oil_fallback')} FROM d_oil_fallback")
def oil_fallback(spark, sf_dir):
    return rounded(R.oil_fallback(R.oil_roll(V.dense_oil(spark, sf_dir))))


def _lag_roll_sql(gap):
    return f"""SELECT store_nbr, item_nbr, date, {r6('sales_lag28', 'sales_roll14')}, sales_roll14_cnt,
        CASE WHEN sales_lag28 IS NULL THEN 0 ELSE 1 END AS sales_lag28_avail,
        round(sales_roll14_cnt / 14.0, 6) + 0.0 AS sales_roll14_frac
        FROM ({W.lag_roll('s_hist', 'd_sales', gap)}) q"""


def _lag_roll(spark, sf_dir, gap):
    sales = add_target(V.dense_sales(spark, sf_dir))
    past = R.sales_history(sales, "unit_sales_log", order=V.ORDER)
    return rounded(R.sales_lag_roll(past, sales, gap))


_ALL_HIST = f", s_hist AS ({W.hist('d_sales', ALL_DAYS)})"


@query("sales_lag_roll", _lag_roll_sql(GAP), _ALL_HIST)
def sales_lag_roll(spark, sf_dir):
    return _lag_roll(spark, sf_dir, GAP)


@query("sales_lag_roll_no_gap", _lag_roll_sql(0), _ALL_HIST)
def sales_lag_roll_no_gap(spark, sf_dir):
    return _lag_roll(spark, sf_dir, 0)


# ---------------------------------------------------------------- holidays


@query("holiday_observed", "SELECT * FROM d_observed")
def holiday_observed(spark, sf_dir):
    return H.observed(V.dense_holidays(spark, sf_dir))


@query("holiday_national", "SELECT * FROM d_national")
def holiday_national(spark, sf_dir):
    return H.national(H.observed(V.dense_holidays(spark, sf_dir)))


@query("holiday_regional", "SELECT * FROM d_regional")
def holiday_regional(spark, sf_dir):
    return H.regional(H.observed(V.dense_holidays(spark, sf_dir)), V.dense_stores(spark, sf_dir))


@query("holiday_local", "SELECT * FROM d_local")
def holiday_local(spark, sf_dir):
    return H.local(H.observed(V.dense_holidays(spark, sf_dir)), V.dense_stores(spark, sf_dir))


@query("holiday_override", "SELECT * FROM d_override")
def holiday_override(spark, sf_dir):
    return H.override(H.observed(V.dense_holidays(spark, sf_dir)), V.dense_stores(spark, sf_dir))


# ---------------------------------------------------------------- lookups onto sales rows


@query(
    "join_items",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)}, coalesce(i.perishable, 0) AS perishable,
        round(coalesce(i.class_freq_in_family, 0), 6) + 0.0 AS class_freq_in_family,
        round(f.item_freq, 6) + 0.0 AS item_freq FROM v_sales s
        LEFT JOIN ({W.item_features('v_items')}) i ON i.item_nbr = s.item_nbr
        LEFT JOIN (SELECT item_nbr, count(*) * 1.0 / (SELECT count(*) FROM v_sales) AS item_freq
                   FROM v_sales GROUP BY item_nbr) f ON f.item_nbr = s.item_nbr""",
)
def join_items(spark, sf_dir):
    sales = V.natural_sales(spark, sf_dir)
    items = V.natural_items(spark, sf_dir)
    state = Q.value_frequency(sales, "item_nbr", "item_freq").join(
        Q.item_features(items), "item_nbr", "full"
    )
    return rounded(
        lookup(sales.select(*ROW_ID), state, ["item_nbr"]).select(
            *ROW_ID,
            F.coalesce("perishable", F.lit(0)).alias("perishable"),
            F.coalesce("class_freq_in_family", F.lit(0.0)).alias("class_freq_in_family"),
            F.coalesce("item_freq", F.lit(0.0)).alias("item_freq"),
        )
    )


@query(
    "join_stores",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)}, coalesce(f.cluster, -1) AS cluster,
        round(coalesce(f.city_freq_in_state, 0), 6) + 0.0 AS city_freq_in_state FROM v_sales s
        LEFT JOIN ({W.store_features('v_sales', 'v_stores')}) f ON f.store_nbr = s.store_nbr""",
)
def join_stores(spark, sf_dir):
    sales, stores = V.natural_sales(spark, sf_dir), V.natural_stores(spark, sf_dir)
    state = Q.store_features(sales, stores)
    return rounded(
        lookup(sales.select(*ROW_ID), state, ["store_nbr"]).select(
            *ROW_ID,
            F.coalesce("cluster", F.lit(-1)).alias("cluster"),
            F.coalesce("city_freq_in_state", F.lit(0.0)).alias("city_freq_in_state"),
        )
    )


@query(
    "join_transactions",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)},
        round(coalesce(t.transactions_roll14, l.last_roll, 0), 6) + 0.0 AS transactions_roll14
        FROM d_sales s LEFT JOIN s_trans t ON t.store_nbr = s.store_nbr AND t.date = s.date
        LEFT JOIN (SELECT store_nbr, max_by(transactions_roll14, date) AS last_roll FROM s_trans
          WHERE transactions_roll14 IS NOT NULL GROUP BY store_nbr) l ON l.store_nbr = s.store_nbr""",
    f", s_trans AS ({W.trans_roll(GAP)})",
)
def join_transactions(spark, sf_dir):
    rolls = R.transactions_roll(V.dense_transactions(spark, sf_dir), GAP)
    rows = lookup(V.dense_sales(spark, sf_dir).select(*ROW_ID), rolls, ["store_nbr", "date"])
    rows = lookup(rows, R.transactions_last(rolls), ["store_nbr"])
    roll = F.coalesce("transactions_roll14", "last_roll", F.lit(0.0))
    return rounded(rows.select(*ROW_ID, roll.alias("transactions_roll14")))


@query(
    "join_oil",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)},
        round(coalesce(o.oil_roll14, (SELECT oil_fallback FROM d_oil_fallback)), 6) + 0.0 AS oil_roll14
        FROM d_sales s LEFT JOIN d_oil_roll o ON o.date = s.date""",
)
def join_oil(spark, sf_dir):
    rolls = R.oil_roll(V.dense_oil(spark, sf_dir))
    rows = lookup(V.dense_sales(spark, sf_dir).select(*ROW_ID), rolls, ["date"])
    roll = F.coalesce(F.col("oil_roll14"), R.oil_fallback(rolls).scalar())
    return rounded(rows.select(*ROW_ID, roll.alias("oil_roll14")))


@query(
    "join_holidays",
    f"""SELECT {', '.join('s.' + c for c in ROW_ID)},
        greatest(coalesce(n.nat_h, 0), coalesce(o.h, 0)) AS is_holiday_effective FROM d_sales s
        LEFT JOIN d_national n ON n.date = s.date
        LEFT JOIN d_override o ON o.date = s.date AND o.store_nbr = s.store_nbr""",
)
def join_holidays(spark, sf_dir):
    seen = H.observed(V.dense_holidays(spark, sf_dir))
    rows = lookup(V.dense_sales(spark, sf_dir).select(*ROW_ID), H.national(seen), ["date"])
    rows = lookup(rows, H.override(seen, V.dense_stores(spark, sf_dir)), ["date", "store_nbr"])
    flag = F.greatest(F.coalesce("nat_h", F.lit(0)), F.coalesce("h", F.lit(0)))
    return rows.select(*ROW_ID, flag.alias("is_holiday_effective"))


# ---------------------------------------------------------------- features


_FLOATS = {
    "store_freq", "item_freq", "family_freq_items", "class_freq_items", "class_freq_in_family",
    "type_freq", "state_freq", "city_freq", "city_freq_in_state", "transactions_roll14",
    "oil_roll14", "sales_lag28", "sales_roll14", "sales_roll14_frac",
}
_FEATURE_SQL = ", ".join(r6(c) if c in _FLOATS else c for c in M.FEATURES)


def _features_sql(history, requests, days, body):
    return body, W.features(history, requests, GAP, days)


_FULL = _features_sql(
    "d_sales", "d_sales", ALL_DAYS, f"SELECT {', '.join(ROW_ID)}, {_FEATURE_SQL} FROM enriched"
)


def _fitted(spark, sf_dir, history, days=ALL_DAYS, sales=None):
    return M.FeatureEstimator(
        tables=V.dense_tables(spark, sf_dir, sales),
        feature_gap_days=GAP,
        sales_history_days=days,
        order=V.ORDER,
    ).fit(history)


@query("features_full", *_FULL)
def features_full(spark, sf_dir):
    """Fit on the whole table, transform the whole table."""
    sales = add_target(V.dense_sales(spark, sf_dir))
    model = _fitted(spark, sf_dir, sales)
    out = model.transform(V.dense_sales(spark, sf_dir))
    return rounded(out.select(*ROW_ID, *M.FEATURES))


# The usual evaluation: fit on the train part with 120 days of history, transform the test part.
_AGED = "(SELECT max(date) FROM d_sales) - date"
_PARTS = f""",
    h_train AS (SELECT * FROM d_sales WHERE {_AGED} BETWEEN 17 AND 83),
    h_test AS (SELECT * FROM d_sales WHERE {_AGED} <= 13)"""


def _holdout_sql(body):
    return body, _PARTS + W.features("h_train", "h_test", GAP, 120)


def _holdout(spark, sf_dir):
    train_rows, _, test_rows = time_split(add_target(V.dense_sales(spark, sf_dir)))
    return _fitted(spark, sf_dir, train_rows, 120).transform(test_rows)


@query(
    "features_holdout",
    *_holdout_sql(f"SELECT {', '.join(ROW_ID)}, {_FEATURE_SQL} FROM enriched"),
)
def features_holdout(spark, sf_dir):
    return rounded(_holdout(spark, sf_dir).select(*ROW_ID, *M.FEATURES))


_MATRIX_SQL = ", ".join(
    f"round(CAST(coalesce({c}, 0) AS DOUBLE), 6) + 0.0 AS {c}" for c in MODEL_FEATURES
)


@query(
    "feature_matrix",
    *_features_sql(
        "d_sales",
        "d_sales",
        ALL_DAYS,
        f"SELECT l_orderkey, l_linenumber, {_MATRIX_SQL}, CAST(0 AS DOUBLE) AS absent FROM enriched",
    ),
)
def feature_matrix(spark, sf_dir):
    stored = V.stored_sales(spark, sf_dir)
    sales = add_target(stored)
    enriched = _fitted(spark, sf_dir, sales, sales=stored).transform(sales)
    return rounded(align(enriched, [*MODEL_FEATURES, "absent"], ["l_orderkey", "l_linenumber"]))


# ---------------------------------------------------------------- metrics


def _naive(spark, sf_dir):
    """The 14-day mean as forecast, so that the metrics have an exact expected value."""
    sales = add_target(V.dense_sales(spark, sf_dir))
    past = R.sales_history(sales, "unit_sales_log", order=V.ORDER)
    rolls = R.sales_lag_roll(past, sales, GAP).select(*R.KEY, "sales_roll14")
    guess = F.coalesce("sales_roll14", F.lit(0.0))
    return sales.join(rolls, R.KEY, "left").select(
        *ROW_ID,
        F.col("unit_sales_log").alias("y_log"),
        guess.alias("y_pred_log"),
        F.col("unit_sales_clean").alias("y"),
        S.units_from_log(guess).alias("y_pred"),
    )


_NAIVE = f"""{_ALL_HIST}, s_roll AS ({W.lag_roll('s_hist', 'd_sales', GAP)}),
    naive AS (SELECT s.*, ln(1 + unit_sales_pos) AS y_log, coalesce(sales_roll14, 0) AS y_pred_log,
      unit_sales_pos AS y, exp(coalesce(sales_roll14, 0)) - 1 AS y_pred
      FROM d_pos s LEFT JOIN s_roll USING (store_nbr, item_nbr, date))"""


def _metric_sql(y, pred, suffix):
    err = f"({y} - {pred})"
    return f"""round(sqrt(avg({err} * {err})), 4) AS RMSE_{suffix}, round(avg(abs({err})), 4) AS MAE_{suffix},
        round(1 - sum({err} * {err}) / sum(({y} - mean_{y}) * ({y} - mean_{y})), 4) AS R2_{suffix}"""


@query(
    "naive_metrics",
    f"""SELECT {_metric_sql('y_log', 'y_pred_log', 'log')}, {_metric_sql('y', 'y_pred', 'raw')},
        round(avg(y), 4) AS Mean_y_true_raw, round(avg(y_pred), 4) AS Mean_y_pred_raw, count(*) AS n_rows
        FROM naive CROSS JOIN (SELECT avg(y_log) AS mean_y_log, avg(y) AS mean_y FROM naive) m""",
    _NAIVE,
)
def naive_metrics(spark, sf_dir):
    return rounded(regression_metrics(_naive(spark, sf_dir)), 4)


@query(
    "worst_errors",
    f"""SELECT {', '.join(ROW_ID)}, round(y_pred, 6) AS y_pred, round(abs(y - y_pred), 6) AS abs_err
        FROM naive ORDER BY abs(y - y_pred) DESC, {', '.join(ROW_ID)} LIMIT 200""",
    _NAIVE,
)
def worst_naive_errors(spark, sf_dir):
    worst = worst_errors(_naive(spark, sf_dir), ROW_ID)
    return rounded(worst.select(*ROW_ID, "y_pred", "abs_err"))


@query(
    "sampled_eval",
    """SELECT CAST(least(5000, count(*)) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_foreign,
       CAST(0 AS BIGINT) AS n_changed FROM d_sales""",
)
def sampled_eval(spark, sf_dir):
    """An exact sample: its size, its rows that the source lacks, and those a second draw lacks."""
    source = V.dense_sales(spark, sf_dir)
    drawn, again = exact_sample(source, 5000), exact_sample(source.repartition(*source.columns), 5000)

    def missing(other):
        return drawn.exceptAll(other).agg(F.count("*").alias("n")).scalar()

    size = drawn.agg(F.count("*").alias("n_rows"))
    return size.select("n_rows", missing(source).alias("n_foreign"), missing(again).alias("n_changed"))


# ---------------------------------------------------------------- model and forecast


_GRID_DAYS = 14


def _grid(spark, sf_dir, sales=None):
    stores = V.dense_stores(spark, sf_dir)
    latest = P.last_day(V.dense_sales(spark, sf_dir) if sales is None else sales)
    first, last = latest + dt.timedelta(days=1), latest + dt.timedelta(days=_GRID_DAYS)
    return V.dense_items(spark, sf_dir), stores, first, last


@query(
    "forecast_grid",
    f"""SELECT CAST(m.latest + k AS DATE) AS date, store_nbr, item_nbr, false AS onpromotion
        FROM d_stores CROSS JOIN d_items CROSS JOIN (SELECT max(date) AS latest FROM d_sales) m
        CROSS JOIN (SELECT CAST(unnest(range(1, {_GRID_DAYS + 1})) AS INT) AS k) d""",
)
def forecast_requests(spark, sf_dir):
    return forecast_grid(*_grid(spark, sf_dir))


# The whole table is the training window. A small ensemble, so that the checks end: the engine's
# default is 1,000 trees of 255 bins, and each tree is a few more jobs of the same kind.
CONFIG = TrainConfig(
    weeks_window=5200, total_days=ALL_DAYS, sales_history_days=ALL_DAYS, n_trees=10, max_bins=32
)

_TEST_DAYS = "(SELECT max(date) - 13 FROM d_sales)"


def _predicted():
    """Whether there is a prediction, and its two forms agree."""
    back = F.expm1(F.least(F.greatest("y_pred_log", F.lit(-50.0)), F.lit(50.0)))
    return F.coalesce(F.abs(F.col("y_pred") - back) <= 1e-9 * (1 + F.abs(back)), F.lit(False)).alias("predicted")


@query(
    "model_scores",
    f"""SELECT {', '.join(ROW_ID)}, round(ln(1 + unit_sales_pos), 6) + 0.0 AS unit_sales_log, true AS predicted
        FROM d_pos WHERE date >= {_TEST_DAYS}""",
)
def model_scores(spark, sf_dir):
    """Train on all but the last days, score the last days."""
    sales = V.stored_sales(spark, sf_dir)
    run_dir = shared_dir(spark, "run")
    train(sales, V.dense_tables(spark, sf_dir, sales), run_dir, CONFIG, V.ORDER)
    run = RunRegistry(spark, run_dir).load(run_dir)
    sizes, latest = fit_sizes_to(sales, ALL_DAYS)
    _, _, test_rows = time_split(add_target(sales), sizes, latest=latest)
    enriched = run.features.transform(test_rows)
    scored = score(enriched, run.model, run.feature_cols, [*ROW_ID, "unit_sales_log"])
    return rounded(scored.select(*ROW_ID, "unit_sales_log", _predicted()))


def _published(spark, sf_dir):
    """The dense sales as a Parquet source, trained and published by the scheduled job: (registry, sales)."""
    root = shared_dir(spark, "registry")
    sales = V.stored_sales(spark, sf_dir, f"{root}/sales")
    run_if_new(spark, f"{root}/sales", V.dense_tables(spark, sf_dir, sales), root, CONFIG, V.ORDER)
    return RunRegistry(spark, root), sales


_REPORTED = ["train_min_date", "train_max_date", "gap_min_date", "gap_max_date", "test_min_date", "test_max_date"]
_COUNTED = ["total_days", "test_days", "gap_days", "n_train_fit", "n_gap", "n_test", "n_features"]


@query(
    "published_run",
    f"""SELECT *, CAST({len(MODEL_FEATURES)} AS BIGINT) AS n_features FROM (SELECT
        {', '.join(f"CAST({agg}(CASE WHEN split = '{part}' THEN date END) AS VARCHAR) AS {part}_{agg}_date"
                   for part in ("train", "gap", "test") for agg in ("min", "max"))},
        CAST(max(date) - min(date) + 1 AS BIGINT) AS total_days, CAST(14 AS BIGINT) AS test_days, CAST(3 AS BIGINT) AS gap_days,
        count(CASE WHEN split = 'train' THEN 1 END) AS n_train_fit, count(CASE WHEN split = 'gap' THEN 1 END) AS n_gap,
        count(CASE WHEN split = 'test' THEN 1 END) AS n_test
        FROM (SELECT date, CASE WHEN date >= {_TEST_DAYS} THEN 'test'
            WHEN date >= {_TEST_DAYS} - 3 THEN 'gap' ELSE 'train' END AS split FROM d_sales) q) r""",
)
def published_run(spark, sf_dir):
    """What the listed run says about its split."""
    runs = _published(spark, sf_dir)[0].runs()
    return runs.select(
        *[F.get_json_object("metadata", f"$.{c}").alias(c) for c in _REPORTED],
        *[F.get_json_object("metadata", f"$.{c}").cast("bigint").alias(c) for c in _COUNTED],
    )


@query(
    "evaluate_latest",
    f"""SELECT count(*) AS n_rows, round(avg(unit_sales_pos), 4) AS Mean_y_true_raw, true AS measured
        FROM d_pos WHERE date >= {_TEST_DAYS}""",
)
def evaluate_latest(spark, sf_dir):
    """All rows of the latest days; the errors depend on the trees, so only their order is compared."""
    registry, sales = _published(spark, sf_dir)
    metrics = evaluate(sales, registry.load_latest()).metrics
    measured = (F.col("RMSE_raw") >= F.col("MAE_raw")) & (F.col("RMSE_log") >= F.col("MAE_log")) & (F.col("MAE_log") > 0)
    return metrics.select("n_rows", F.round("Mean_y_true_raw", 4).alias("Mean_y_true_raw"), measured.alias("measured"))


@query(
    "forecast_period",
    f"""SELECT CAST(m.latest + k AS DATE) AS date, store_nbr, item_nbr, false AS onpromotion, true AS predicted
        FROM d_stores CROSS JOIN d_items CROSS JOIN (SELECT max(date) AS latest FROM d_sales) m
        CROSS JOIN (SELECT CAST(unnest(range(1, {_GRID_DAYS + 1})) AS INT) AS k) d""",
)
def forecast_next_days(spark, sf_dir):
    registry, sales = _published(spark, sf_dir)
    return forecast_period(registry.load_latest(), *_grid(spark, sf_dir, sales)).select(
        "date", "store_nbr", "item_nbr", "onpromotion", _predicted()
    )


# ---------------------------------------------------------------- a published formula
# The same way from training to forecast with a model whose predictions SQL can work out.

FORMULA = {"sales_roll14": 0.45, "sales_lag28": 0.2, "onpromo": 0.3, "store_freq": 4.0, "item_freq": -2.5, "is_weekend": 0.125,
           "is_holiday_effective": 0.25, "oil_roll14": 0.01, "transactions_roll14": 0.002, "dow": -0.015}
INTERCEPT = 0.75
_LOG_SQL = " + ".join([f"CAST({INTERCEPT} AS DOUBLE)", *(f"CAST({w} AS DOUBLE) * coalesce({c}, 0)" for c, w in FORMULA.items())])
_PREDICTED = f"{_LOG_SQL} AS y_pred_log, exp(least(greatest({_LOG_SQL}, -50), 50)) - 1 AS y_pred"
# The published run is fitted on the days before the gap and the test part.
_TRAIN_PART = f""",
    f_train AS (SELECT * FROM d_sales WHERE date < {_TEST_DAYS} - 3),
    f_test AS (SELECT * FROM d_pos WHERE date >= {_TEST_DAYS}),
    f_grid AS (SELECT CAST(m.latest + k AS DATE) AS date, store_nbr, item_nbr, false AS onpromotion
        FROM d_stores CROSS JOIN d_items CROSS JOIN (SELECT max(date) AS latest FROM d_sales) m
        CROSS JOIN (SELECT CAST(unnest(range(1, {_GRID_DAYS + 1})) AS INT) AS k) d),
    f_point AS (SELECT CAST(max(date) + 1 AS DATE) AS date, CAST(7 AS BIGINT) AS store_nbr, CAST(11 AS BIGINT) AS item_nbr, true AS onpromotion FROM d_sales)"""


def _formula_sql(requests):
    return _TRAIN_PART + W.features("f_train", requests, GAP, ALL_DAYS)


def _published_formula(spark, sf_dir):
    """The dense sales as a Parquet source, and the formula published by the scheduled job: (run, sales)."""
    root = shared_dir(spark, "registry")
    sales = V.stored_sales(spark, sf_dir, f"{root}/sales")
    tables = V.dense_tables(spark, sf_dir, sales)
    run_if_new(spark, f"{root}/sales", tables, root, CONFIG, V.ORDER, learner=formula(FORMULA, INTERCEPT))
    return RunRegistry(spark, root).load_latest(), sales


@query(
    "formula_scores",
    f"SELECT {', '.join(ROW_ID)}, round(y_pred_log, 6) + 0.0 AS y_pred_log, round(y_pred, 6) + 0.0 AS y_pred FROM (SELECT *, {_PREDICTED} FROM enriched) q",
    _formula_sql("f_test"),
)
def formula_scores(spark, sf_dir):
    """Predictions of a published, loaded model for the last days."""
    run, sales = _published_formula(spark, sf_dir)
    last_days = P.trailing_days(sales, 14)
    scored = score(run.features.enrich(last_days), run.model, run.feature_cols, ROW_ID)
    return rounded(scored.select(*ROW_ID, "y_pred_log", "y_pred"))


@query(
    "formula_metrics",
    f"""SELECT {_metric_sql('y_log', 'y_pred_log', 'log')}, {_metric_sql('y', 'y_pred', 'raw')},
        round(avg(y), 4) AS Mean_y_true_raw, round(avg(y_pred), 4) AS Mean_y_pred_raw, count(*) AS n_rows
        FROM scored CROSS JOIN (SELECT avg(y_log) AS mean_y_log, avg(y) AS mean_y FROM scored) m""",
    _formula_sql("f_test") + f", scored AS (SELECT unit_sales_pos AS y, ln(1 + unit_sales_pos) AS y_log, {_PREDICTED} FROM enriched)",
)
def formula_metrics(spark, sf_dir):
    """The evaluation of the latest run, all rows of the latest days, both spaces."""
    run, sales = _published_formula(spark, sf_dir)
    return rounded(evaluate(sales, run).metrics, 4)


@query(
    "formula_worst",
    f"""SELECT date, store_nbr, item_nbr, onpromotion, round(y, 6) + 0.0 AS y_true_unit_sales, round(y_pred, 6) + 0.0 AS y_pred_unit_sales,
        round(abs(y - y_pred), 6) + 0.0 AS abs_err FROM scored ORDER BY abs(y - y_pred) DESC, date, store_nbr, item_nbr, onpromotion LIMIT 200""",
    _formula_sql("f_test") + f", scored AS (SELECT *, unit_sales_pos AS y, {_PREDICTED} FROM enriched)",
)
def formula_worst(spark, sf_dir):
    """The evaluation's list of the rows with the largest errors."""
    run, sales = _published_formula(spark, sf_dir)
    return rounded(evaluate(sales, run).worst)


@query(
    "formula_period",
    f"""SELECT date, store_nbr, item_nbr, onpromotion, round(y_pred_log, 6) + 0.0 AS y_pred_log, round(y_pred, 6) + 0.0 AS y_pred
        FROM (SELECT *, {_PREDICTED} FROM enriched) q""",
    _formula_sql("f_grid"),
)
def formula_period(spark, sf_dir):
    run, sales = _published_formula(spark, sf_dir)
    return rounded(forecast_period(run, *_grid(spark, sf_dir, sales)).select("date", "store_nbr", "item_nbr", "onpromotion", "y_pred_log", "y_pred"))


@query(
    "forecast_point",
    f"""SELECT date, store_nbr, item_nbr, onpromotion, round(y_pred_log, 6) + 0.0 AS y_pred_log, round(y_pred, 6) + 0.0 AS y_pred
        FROM (SELECT *, {_PREDICTED} FROM enriched) q""",
    _formula_sql("f_point"),
)
def point_forecast(spark, sf_dir):
    """One request: a store, an item, the day after the latest, on promotion."""
    run, sales = _published_formula(spark, sf_dir)
    day = P.last_day(sales) + dt.timedelta(days=1)
    return rounded(forecast_point(spark, run, day, 7, 11, True).select("date", "store_nbr", "item_nbr", "onpromotion", "y_pred_log", "y_pred"))


@query(
    "build_summary",
    f"""SELECT CAST({len(MODEL_FEATURES)} AS BIGINT) AS n_features, 'FormulaModel' AS model_type, true AS same_as_metadata,
        true AS same_run, CAST(5200 AS BIGINT) AS weeks_window, {_metric_sql('y', 'y_pred', 'raw')}, count(*) AS n_test
        FROM scored CROSS JOIN (SELECT avg(y) AS mean_y FROM scored) m""",
    _formula_sql("f_test") + f", scored AS (SELECT unit_sales_pos AS y, {_PREDICTED} FROM enriched)",
)
def build_summary(spark, sf_dir):
    """What the unconditional build writes, read back from its files: the summary and the run's metadata."""
    root = shared_dir(spark, "registry")
    V.dense_sales(spark, sf_dir).write.parquet(f"{root}/sales")
    build_now(spark, f"{root}/sales", V.dense_tables(spark, sf_dir), root, CONFIG, order=V.ORDER, learner=formula(FORMULA, INTERCEPT))
    summary = read_json(spark, f"{root}/build_summary.json")
    metadata = load_metadata(spark, summary["latest"]["run_dir"])
    newest = RunRegistry(spark, root).latest()
    row = (
        metadata["n_features"],
        metadata["model_type"],
        summary["metrics"] == metadata,
        newest["run_id"] == summary["latest"]["run_id"],
        summary["config"]["weeks_window"],
        *(metadata[f"{m}_raw"] for m in ("RMSE", "MAE", "R2")),
        metadata["n_test"],
    )
    kinds = "n_features bigint, model_type string, same_as_metadata boolean, same_run boolean, weeks_window bigint, RMSE_raw double, MAE_raw double, R2_raw double, n_test bigint"
    return rounded(spark.createDataFrame([row], kinds), 4)


@query(
    "daily_fit",
    f"SELECT {', '.join(ROW_ID)}, {_FEATURE_SQL} FROM enriched",
    f""",
    h_span AS (SELECT * FROM d_sales WHERE {_AGED} BETWEEN 1 AND 90),
    h_last AS (SELECT * FROM d_sales WHERE {_AGED} <= 13)"""
    + W.features("h_span", "h_last", GAP, 60),
)
def daily_fit(spark, sf_dir):
    """Features fitted from daily sums, which took the days in two steps, for the last days."""
    sales = add_target(V.dense_sales(spark, sf_dir))
    latest = P.last_day(sales)
    span = sales.filter(F.col("date").between(F.lit(latest - dt.timedelta(days=90)), F.lit(latest - dt.timedelta(days=1))))
    daily = DailyState(spark, shared_dir(spark, "daily"), order=V.ORDER)
    daily.add_new(span.filter(F.col("date") < F.lit(latest - dt.timedelta(days=7))))
    daily.add_new(span)
    fit = M.FeatureEstimator(tables=V.dense_tables(spark, sf_dir), feature_gap_days=GAP, sales_history_days=60, order=V.ORDER).fit_daily(daily)
    return rounded(fit.transform(P.trailing_days(V.dense_sales(spark, sf_dir), 14)).select(*ROW_ID, *M.FEATURES))


@query(
    "file_hashes",
    "SELECT CAST(date AS DATE) AS date, count(*) AS n_rows, true AS same_as_scan, CAST(0 AS BIGINT) AS files_read_again FROM d_sales GROUP BY date",
)
def file_hashes(spark, sf_dir):
    """The source's days from kept file hashes, after one more day's files, compared with a scan of all rows."""
    root = shared_dir(spark, "hashes")
    sales = V.dense_sales(spark, sf_dir).select(*R.KEY, "onpromotion", "unit_sales")
    latest = P.last_day(sales)
    hashes = FileHashes(spark, f"{root}/table")
    sales.filter(F.col("date") < F.lit(latest)).write.parquet(f"{root}/sales")
    hashes.update(f"{root}/sales", readers.coerce_sales)
    old = hashes.listing(f"{root}/sales").count()
    sales.filter(F.col("date") == F.lit(latest)).write.mode("append").parquet(f"{root}/sales")
    days = hashes.update(f"{root}/sales", readers.coerce_sales)
    again = hashes.scanned - (hashes.listing(f"{root}/sales").count() - old)
    scan = content_fingerprint(readers.coerce_sales(spark.read.parquet(f"{root}/sales")))
    same = total_signature(days) == scan
    return days.select("date", "n_rows", F.lit(same).alias("same_as_scan"), F.lit(again).cast("bigint").alias("files_read_again"))
