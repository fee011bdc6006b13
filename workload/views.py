"""The retail tables, as views over the generated test tables.

Two grains. Natural (store = supplier, item = part) suits exploration; dense (store = nation,
item = part size) gives series long enough for lags.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from shelfcast.session import shared_dir
from shelfcast.sources.readers import RetailTables

# Rows sharing a (store, item, date): the last one by these columns counts.
ORDER = ["l_orderkey", "l_linenumber", "unit_sales"]

SALES_RENAME = {
    "l_shipdate": "date",
    "l_suppkey": "store_nbr",
    "l_partkey": "item_nbr",
    "l_quantity": "unit_sales",
}


_TABLES = {}


def _table(spark, sf_dir, name):
    """The table, opened once per session: every opening reads the file's footer in a job."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def natural_sales(spark, sf_dir):
    units = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").cast("bigint").alias("store_nbr"),
        F.col("l_partkey").cast("bigint").alias("item_nbr"),
        (F.col("l_discount") > 0.05).alias("onpromotion"),
        units.alias("unit_sales"),
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
    )


def _part_class():
    return F.substring("p_brand", 7, 100).cast("int")


def _perishable():
    return (F.col("p_size") <= 10).cast("int")


def natural_items(spark, sf_dir):
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("item_nbr"),
        F.col("p_type").alias("family"),
        _part_class().alias("class"),
        _perishable().alias("perishable"),
    )


def _places(spark, sf_dir):
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def natural_stores(spark, sf_dir):
    key = F.col("s_suppkey")
    return (
        _table(spark, sf_dir, "supplier")
        .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            key.cast("bigint").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.char(F.lit(65) + key % 5).alias("type"),
            (key % 17).cast("int").alias("cluster"),
        )
    )


def dense_sales(spark, sf_dir):
    sales = natural_sales(spark, sf_dir)
    nation_of = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("store_nbr"), "s_nationkey"
    )
    size_of = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("item_nbr"), "p_size"
    )
    return (
        sales.join(nation_of, "store_nbr")
        .join(size_of, "item_nbr")
        .select(
            "date",
            F.col("s_nationkey").cast("bigint").alias("store_nbr"),
            F.col("p_size").cast("bigint").alias("item_nbr"),
            "onpromotion",
            "unit_sales",
            "l_orderkey",
            "l_linenumber",
            "l_linestatus",
        )
    )


def dense_items(spark, sf_dir):
    return (
        _table(spark, sf_dir, "part")
        .groupBy(F.col("p_size").cast("bigint").alias("item_nbr"))
        .agg(
            F.min("p_type").alias("family"),
            F.min(_part_class()).alias("class"),
            F.max(_perishable()).alias("perishable"),
        )
    )


def dense_stores(spark, sf_dir):
    key = F.col("n_nationkey")
    return _places(spark, sf_dir).select(
        key.cast("bigint").alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.char(F.lit(65) + key % 5).alias("type"),
        (key % 17).alias("cluster"),
    )


def stored_sales(spark, sf_dir, path=None):
    """The dense sales, joined once and written: a query that reads them several times reads that."""
    path = path or shared_dir(spark, "sales")
    dense_sales(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def dense_transactions(spark, sf_dir, sales=None):
    return (
        (dense_sales(spark, sf_dir) if sales is None else sales)
        .groupBy("date", "store_nbr", "l_linestatus")
        .agg(F.count_distinct("l_orderkey").cast("double").alias("transactions"))
        .drop("l_linestatus")
    )


def dense_oil(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    daily = (
        _table(spark, sf_dir, "orders")
        .groupBy(day.alias("date"))
        .agg((F.min("o_totalprice") / 1000).alias("price"))
        .filter(F.weekday("date") < 5)
    )
    return daily.select(
        "date", F.when(F.dayofmonth("date") % 7 != 0, F.col("price")).alias("dcoilwtico")
    )


def dense_holidays(spark, sf_dir):
    days = _table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    days = days.filter(F.dayofmonth("d").isin(1, 10, 20)).distinct()
    month, day = F.month("d"), F.dayofmonth("d")
    raw = days.join(_table(spark, sf_dir, "region"), F.col("r_regionkey") == month % 5).select(
        "d",
        F.when(day == 1, "National").when(day == 10, "Regional").otherwise("Local").alias("locale"),
        F.when(day == 1, "ALL")
        .when(day == 10, F.col("r_name"))
        .otherwise(F.concat(F.lit("NATION_"), (month * 2).cast("string")))
        .alias("locale_name"),
        F.concat(F.lit("H"), F.year("d").cast("string"), F.lit("-"), month.cast("string")).alias(
            "description"
        ),
        (month % 4 == 0).alias("transferred"),
    )
    cols = ["date", "type", "locale", "locale_name", "description", "transferred"]
    holidays = raw.select(F.col("d").alias("date"), F.lit("Holiday").alias("type"), *cols[2:])
    transfers = raw.filter("transferred").select(
        F.date_add("d", 3).alias("date"),
        F.lit("Transfer").alias("type"),
        *cols[2:5],
        F.lit(False).alias("transferred"),
    )
    return holidays.unionByName(transfers)


def dense_tables(spark, sf_dir, sales=None):
    """``sales``: the stored sales, where a query has them."""
    return RetailTables(
        items=dense_items(spark, sf_dir),
        stores=dense_stores(spark, sf_dir),
        transactions=dense_transactions(spark, sf_dir, sales),
        oil=dense_oil(spark, sf_dir),
        holidays=dense_holidays(spark, sf_dir),
    )


def dense(spark, sf_dir):
    return SimpleNamespace(
        sales=dense_sales(spark, sf_dir), tables=dense_tables(spark, sf_dir)
    )
