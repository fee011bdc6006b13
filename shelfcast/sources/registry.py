"""Versioned runs: artifacts in a folder per run, and one table that lists finished runs."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from shelfcast.plans.features import FeatureModel
from shelfcast.sources.artifacts import exists, load_metadata, read_json

# Parts of a finished run.
REQUIRED = ["model/metadata", "state/params", "features.json", "metadata.json"]

RUNS_SCHEMA = """run_id string, run_dir string, trained_at string, fingerprint string,
    feature_cols array<string>, metrics map<string,double>, metadata string"""


@dataclass
class Run:
    """A published run, loaded."""

    run_id: str
    model: PipelineModel
    features: FeatureModel
    feature_cols: list
    metadata: dict


class RunRegistry:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def runs_path(self):
        return f"{self.root}/runs_table"

    def new_run_id(self):
        return dt.datetime.now().strftime("%Y%m%d_%H%M%S_%f")

    def run_dir(self, run_id):
        return f"{self.root}/runs/{run_id}"

    def runs(self):
        """All finished runs; empty before the first."""
        if not exists(self.spark, self.runs_path):
            return self.spark.createDataFrame([], RUNS_SCHEMA)
        return self.spark.read.schema(RUNS_SCHEMA).parquet(self.runs_path)

    def publish(self, run_id, metadata):
        """Lists the run once all its parts are there. Readers only see listed runs, so an
        interrupted training is never picked up."""
        folder = self.run_dir(run_id)
        missing = [part for part in REQUIRED if not exists(self.spark, f"{folder}/{part}")]
        if missing:
            raise FileNotFoundError(f"run {run_id} lacks {missing}")
        metrics = {
            k: float(v) for k, v in metadata.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)
        }
        fingerprint = metadata.get("data_signature", {}).get("fingerprint")
        row = (
            run_id,
            folder,
            metadata.get("trained_at"),
            fingerprint,
            read_json(self.spark, f"{folder}/features.json", []),
            metrics,
            json.dumps(metadata, ensure_ascii=False),
        )
        table = self.spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1)
        table.write.mode("append").parquet(self.runs_path)
        return self.latest()

    def latest(self):
        """The newest run as a dict with parsed metadata, or ``None``."""
        newest = self.runs().agg(F.max_by(F.struct("*"), "run_id").alias("run")).first()["run"]
        if newest is None:
            return None
        found = newest.asDict(recursive=True)
        return {**found, "metadata": json.loads(found["metadata"])}

    def latest_metadata(self):
        """Metadata of the newest run; {} when there is none."""
        newest = self.latest()
        return newest["metadata"] if newest else {}

    def load(self, run_dir, run_id=None):
        """Model, fitted features, feature list and metadata of a run folder."""
        for part in REQUIRED[:3]:
            if not exists(self.spark, f"{run_dir}/{part}"):
                raise FileNotFoundError(f"{run_dir}/{part}")
        return Run(
            run_id,
            PipelineModel.load(f"{run_dir}/model"),
            FeatureModel.load(self.spark, f"{run_dir}/state"),
            read_json(self.spark, f"{run_dir}/features.json"),
            load_metadata(self.spark, run_dir),
        )

    def load_latest(self):
        newest = self.latest()
        if newest is None:
            raise FileNotFoundError(f"no published run under {self.root}")
        return self.load(newest["run_dir"], newest["run_id"])
