"""Versioned model directories and the append-only ``runs`` table.

A run writes its model under ``<root>/<model>/<run_id>`` and appends one row per metric to
``<root>/runs`` (Parquet, append mode). "Latest" is a ``max`` over (ts, run) per model: a
grouped aggregate, not a driver-side scan.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = "run_id string, ts timestamp, model string, params string, split string, metric string, value double, path string"


def latest_runs(runs: DataFrame, model: str = "model", ts: str = "ts", run: str = "run_id") -> DataFrame:
    """Per model: number of runs and the run with the latest (ts, run) pair."""
    best = F.max(F.struct(F.col(ts), F.col(run)))
    return runs.groupBy(model).agg(F.count(F.lit(1)).cast("bigint").alias("n_runs"), best[run].alias("latest_id"))


def model_path(root: str, model: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{model}/{run_id}"


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def log_run(spark: SparkSession, root: str, model: str, run_id: str, params: dict, metrics: dict[tuple[str, str], float], path: str) -> None:
    """Append one row per (split, metric) to ``<root>/runs``."""
    ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [
        (run_id, ts, model, json.dumps(params, sort_keys=True, default=str), split, metric, float(v), path)
        for (split, metric), v in metrics.items()
    ]
    spark.createDataFrame(rows, RUNS_SCHEMA).write.mode("append").parquet(f"{root.rstrip('/')}/runs")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(f"{root.rstrip('/')}/runs")


def resolve_model_path(spark: SparkSession, root: str, model: str, explicit: str | None = None) -> str:
    """The explicit path when given, else the path of the model's latest run."""
    if explicit:
        return explicit
    runs = read_runs(spark, root).where(F.col("model") == model)
    row = runs.agg(F.max(F.struct("ts", "run_id", "path")).alias("m")).first()
    if row is None or row["m"] is None:
        raise FileNotFoundError(f"no runs for {model} under {root}")
    return row["m"]["path"]
