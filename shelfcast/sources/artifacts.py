"""Small JSON documents, existence checks and CSV export, through Spark's file systems."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException


def exists(spark, path):
    """Whether there is something at ``path``. Only its absence counts as absence: any other
    failure (no permission, a broken store) is raised, so that it is not taken for "no runs"."""
    try:
        spark.read.text(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_json(spark, path, obj):
    """One document per path (a folder with a single part file)."""
    text = json.dumps(obj, ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark, path, default=None):
    """The document at ``path`` (plain file or written by ``write_json``), else ``default``."""
    if not exists(spark, path):
        return default
    row = spark.read.text(path, wholetext=True).first()
    return default if row is None else json.loads(row[0])


def load_metadata(spark, run_dir):
    """Run metadata; {} when there is none."""
    return read_json(spark, f"{run_dir}/metadata.json", {})


def load_metrics(spark, run_dir):
    """metadata.json if present, else metrics.json, else ``None``."""
    found = read_json(spark, f"{run_dir}/metadata.json")
    return read_json(spark, f"{run_dir}/metrics.json") if found is None else found


def export_csv(df, path):
    """Scored rows as CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
