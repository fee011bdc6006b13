"""What a feature fit needs of the sales history, kept by day, so that a new day is the only one read.

Two tables, partitioned by day: rows per store and item, and the deduplicated lag history. Both are
sums over days (rows with one store, item and day are of one day), so a fit adds up the days it wants
instead of reading the history. A third, small one lists the days with what was read of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfcast.functions.coerce import as_date, as_id, not_null, require_columns
from shelfcast.operators import rolling
from shelfcast.operators.rolling import KEY
from shelfcast.sources.artifacts import read_json, write_json
from shelfcast.sources.fingerprint import day_sums

COUNTS = "store_nbr bigint, item_nbr bigint, n bigint, date date"
HISTORY = "store_nbr bigint, item_nbr bigint, y double, date date"
DAYS = "date date, n_rows bigint, hash_sum string"


class DailyState:
    """The state under ``path``.

    ``order`` decides, as in the estimator, which of several rows of one store, item and day counts.
    A day is added whole, and anew when its rows have changed; the list of days is written last, to
    a folder of its own, so an interrupted update leaves the former list.
    """

    def __init__(self, spark, path, target="unit_sales_log", order=()):
        self.spark, self.path, self.target, self.order = spark, path.rstrip("/"), target, list(order)

    def _listed(self):
        return read_json(self.spark, f"{self.path}/days.json", {}).get("folder")

    def days(self):
        """(date, n_rows, hash_sum) of the days that are there."""
        folder = self._listed()
        return self.spark.read.schema(DAYS).parquet(f"{self.path}/{folder}") if folder else self.spark.createDataFrame([], DAYS)

    def _content(self, history):
        return [c for c in dict.fromkeys([*KEY, *self.order, self.target]) if c in history.columns]

    def refresh(self, history, sums=None):
        """Adds the days of ``history`` that are new or changed, drops those it lacks, and returns
        the days that were added.

        ``sums`` are the rows and hash sums of the history's days, where the caller has them (as
        ``FileHashes`` keeps them); otherwise they are summed up here, which reads the history once.
        """
        sums = (day_sums(history.select(*self._content(history))) if sums is None else sums).select("date", "n_rows", "hash_sum")
        sums = self.spark.createDataFrame(sums.collect(), DAYS)  # a row for each calendar day
        changed = [r["date"] for r in sums.exceptAll(self.days()).select("date").distinct().orderBy("date").collect()]
        if changed:
            self._write(history.filter(F.col("date").isin(changed)))
        self._list(sums)
        return changed

    def add_new(self, history):
        """Adds the days after the last one that is there. Reads only these: the caller knows that
        earlier days have not changed."""
        latest = self.days().agg(F.max("date")).first()[0]
        rows = history if latest is None else history.filter(F.col("date") > F.lit(latest))
        sums = self.spark.createDataFrame(day_sums(rows.select(*self._content(rows))).collect(), DAYS)
        added = [r["date"] for r in sums.select("date").orderBy("date").collect()]
        if added:
            self._write(rows)
            self._list(self.days().unionByName(sums))
        return added

    def _write(self, rows):
        require_columns(rows, [*KEY, self.target, *self.order])
        typed = rows.withColumns(
            {
                "date": as_date(rows, "date"),
                "store_nbr": not_null(as_id(rows, "store_nbr"), "store_nbr"),
                "item_nbr": not_null(as_id(rows, "item_nbr"), "item_nbr"),
            }
        )
        counts = typed.groupBy("store_nbr", "item_nbr", "date").agg(F.count(F.lit(1)).alias("n"))
        past = rolling.sales_history(typed, self.target, None, self.order).select("store_nbr", "item_nbr", F.col("y").cast("double").alias("y"), "date")
        for name, table in (("history", past), ("counts", counts)):
            # ranges of days, so that a task writes few of them, and a large day is written by several
            writer = table.repartitionByRange("date", "store_nbr", "item_nbr").write.partitionBy("date")
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{name}")

    def _list(self, sums):
        folder = f"days-{uuid.uuid4().hex}"
        sums.coalesce(1).write.parquet(f"{self.path}/{folder}")
        write_json(self.spark, f"{self.path}/days.json", {"folder": folder})

    def _read(self, name, schema, first, last):
        wanted = self.days()
        if first is not None:
            wanted = wanted.filter(F.col("date") >= F.lit(first))
        if last is not None:
            wanted = wanted.filter(F.col("date") <= F.lit(last))
        days = [r["date"] for r in wanted.select("date").orderBy("date").collect()]
        table = self.spark.read.schema(schema)
        if not days:
            return self.spark.createDataFrame([], schema)
        return table.parquet(f"{self.path}/{name}").filter(F.col("date").isin(days))  # partitions, not rows, are chosen

    def counts(self, first=None, last=None):
        """Rows per store and rows per item (the other key is null), as ``features.key_counts`` has them."""
        rows = self._read("counts", COUNTS, first, last)
        sets = [["store_nbr"], ["item_nbr"]]
        return rows.groupingSets(sets, "store_nbr", "item_nbr").agg(F.sum("n").alias("n"))

    def history(self, first=None, last=None):
        """The deduplicated (date, store_nbr, item_nbr, y) of the days."""
        return self._read("history", HISTORY, first, last).select(*KEY, "y")
