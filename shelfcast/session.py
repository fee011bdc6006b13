"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(app_name="shelfcast", master=None, shuffle_partitions=None, **conf):
    """A session with adaptive execution and skew splitting on.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` generously (two to
    three times the cores): adaptive execution merges the small ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped = set()


def ship_package(spark):
    """Sends this package to the session's Python workers, which need it where a query runs Python.

    A cluster's executors have no copy of the repository; on one machine it does no harm.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="shelfcast-"), "shelfcast.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_dir(spark, label):
    """A fresh folder path under the cluster's shared checkpoint folder.

    Tables written there outlive the executors that wrote them, so the folder has to be set
    (``spark.checkpoint.dir``, storage that every executor reaches). Only a session of a single
    process (``local[..]``), which has no other machine to share with, gets one of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="shelfcast-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df, path):
    """``df`` as written to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
