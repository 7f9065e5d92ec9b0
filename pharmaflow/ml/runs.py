"""Experiment log as tables (M20) and the queries over it.

Runs and model versions are rows in two tables (parquet, append). Params,
metrics and tags are JSON text; metrics are read back with ``from_json``
into a map so any metric can be ranked without a schema change.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.dedup import best_per_group, latest_per_group
from ..session import path_exists

RUNS = StructType([StructField(n, t) for n, t in [
    ("run_id", StringType()), ("experiment", StringType()), ("status", StringType()),
    ("start_time", LongType()), ("end_time", LongType()), ("params", StringType()),
    ("metrics", StringType()), ("tags", StringType())]])

VERSIONS = StructType([StructField(n, t) for n, t in [
    ("name", StringType()), ("version", LongType()), ("stage", StringType()),
    ("run_id", StringType()), ("status", StringType()), ("updated_at", LongType())]])


class RunLog:
    """Append-only run and model-version tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.runs_path = f"{root.rstrip('/')}/runs"
        self.versions_path = f"{root.rstrip('/')}/model_versions"

    def log_run(self, experiment: str, params: Mapping, metrics: Mapping, tags: Mapping | None = None,
                status: str = "FINISHED", start: int | None = None, end: int | None = None) -> str:
        run_id = uuid.uuid4().hex
        now = int(time.time() * 1000)
        row = (run_id, experiment, status, start or now, end or now,
               json.dumps(dict(params), default=str, sort_keys=True),
               json.dumps({k: float(v) for k, v in metrics.items()}, sort_keys=True),
               json.dumps(dict(tags or {}), default=str, sort_keys=True))
        self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(self.runs_path)
        return run_id

    def register_version(self, name: str, run_id: str, stage: str = "None") -> int:
        """New version = 1 + the highest existing version of ``name``."""
        cur = self.versions()
        top = cur.where(F.col("name") == name).agg(F.max("version")).first()[0] if cur is not None else None
        version = int(top or 0) + 1
        row = (name, version, stage, run_id, "READY", int(time.time() * 1000))
        self.spark.createDataFrame([row], VERSIONS).write.mode("append").parquet(self.versions_path)
        return version

    def transition(self, name: str, version: int, stage: str) -> None:
        """Stage change: appended as a newer row; readers take the latest."""
        row = (name, int(version), stage, None, "READY", int(time.time() * 1000) + 1)
        cur = self.versions().where((F.col("name") == name) & (F.col("version") == version))
        run_id = cur.select("run_id").first()
        row = (name, int(version), stage, run_id[0] if run_id else None, "READY", row[-1])
        self.spark.createDataFrame([row], VERSIONS).write.mode("append").parquet(self.versions_path)

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(self.runs_path)

    def versions(self) -> DataFrame | None:
        """The latest row of every version; None before the first one."""
        if not path_exists(self.spark, self.versions_path):
            return None
        raw = self.spark.read.schema(VERSIONS).parquet(self.versions_path)
        return latest_per_group(raw, ["name", "version"], "updated_at")


def metric(col: str, name: str):
    """A metric value out of the JSON metrics text."""
    return F.from_json(F.col(col), "map<string,double>")[name]


def latest_run(runs: DataFrame, experiment: str | None = None) -> DataFrame:
    """Newest run per experiment (or of one experiment)."""
    if experiment is not None:
        runs = runs.where(F.col("experiment") == experiment)
    return latest_per_group(runs, ["experiment"], "start_time", tie=["run_id"])


def best_version(versions: DataFrame, runs: DataFrame, metric_name: str,
                 ascending: bool = False) -> DataFrame:
    """Per model name, the version whose run has the best metric;
    versions lacking the metric are skipped, the lowest version wins ties."""
    j = versions.join(runs.select("run_id", metric("metrics", metric_name).alias("_m")), "run_id")
    return best_per_group(j, ["name"], "_m", ascending=ascending, tie=["version"]) \
        .withColumnRenamed("_m", metric_name)
