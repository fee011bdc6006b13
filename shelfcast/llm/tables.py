"""Written intermediate tables and columns with names of their own."""

from __future__ import annotations

import uuid

from shelfcast.session import shared_dir


def written(df, label):
    """The table, written to the shared folder and read back.

    It cuts the lineage: what a lost executor had computed is read again, not computed again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_A_TASK = 4_096


def gathered(df, rows, each=ROWS_A_TASK):
    """The table in tasks of some ``each`` rows, as it has about ``rows``, but for every core one.

    A session with many partitions would write a small table as that many files, each of which costs
    its executor more than the rows in it. For what follows a shuffle, without a Python function after
    it: a task goes through several partitions in turn, and such a function keeps its buffers till the end.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


BATCH_BYTES = 4 << 20


def bounded_batches(spark):
    """Limits the bytes of the batches that go to Python: rows alone do not bound them, texts can be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name)
    units = {"b": 0, "k": 10, "m": 20, "g": 30}
    if (int(now[:-1]) << units[now[-1]] if now[-1] in units else int(now)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def own_name(df, name):
    """``name``, or a variant of it that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without(df, *names):
    """The table without columns that an operator is about to add (case is ignored, as in Spark)."""
    lower = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in lower])


def set_aside(df, names):
    """The table with its columns of these names renamed, and a function that names them back."""
    lower = {n.lower() for n in names}
    moved = {c: own_name(df, f"{c}_input") for c in df.columns if c.lower() in lower}
    back = [(moved.get(c, c), c) for c in df.columns]
    return df.withColumnsRenamed(moved), lambda out: out.select(*[out[a].alias(b) for a, b in back])
