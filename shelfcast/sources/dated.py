"""Sales stored by day: a folder for each day, so that a period is a set of folders.

The days that are there are the names of the folders. Finding the latest one reads no data, and a
period filter prunes folders before any file is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

FILE_ROWS = 20_000_000


def write_dated(sales, path, file_rows=FILE_ROWS):
    """Stores rows under ``path``/date=.../; a day that has rows here replaces the stored day whole.

    Days that have no rows here stay as they are, so a late day is added, or a corrected one
    rewritten, without touching the others, and a repeated call ends in the same state. Rows without
    a date are left out, as in reading. Rows move once, by day; adaptive execution splits days that
    are larger than a task and packs small ones together, and ``file_rows`` bounds a file.
    """
    dated = sales.withColumn("date", F.col("date").cast("date")).filter(F.col("date").isNotNull())
    rows = dated.hint("rebalance", "date").sortWithinPartitions("date")
    writer = rows.write.partitionBy("date").option("maxRecordsPerFile", int(file_rows))
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def stored_days(spark, path):
    """The days under ``path``, in order, from the names of its folders; none if it is not stored by day.

    One entry a day reaches the driver, so a century is 36,525.
    """
    if not isinstance(path, str) or any(c in path for c in "*?[{"):
        return []
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    days = []
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("date=") and entry.isDirectory():
            try:
                days.append(dt.date.fromisoformat(name[len("date=") :]))
            except ValueError:
                return []  # folders that are not days: the column decides
    return sorted(days)


def recent_days(spark, path, days, weeks):
    """The rows of the last of ``days`` and the ``weeks`` before it; no other folder is even listed."""
    first = days[-1] - dt.timedelta(weeks=int(weeks))
    folders = [f"{path.rstrip('/')}/date={day.isoformat()}" for day in days if day >= first]
    return spark.read.option("basePath", path).parquet(*folders)
