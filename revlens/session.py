"""Spark session helpers.

Nothing here is global: every operator takes the DataFrames it works on and the session
is only needed by readers and by the few operators that cut lineage.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "revlens",
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitter's config wins."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, else the context's own.

    Where neither is set, a local master (one machine: tests, the bench) gets a folder below
    the session's warehouse; on a cluster this raises, since executors could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = os.path.join(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"), "_checkpoints")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for tables written to cut lineage."""
    return f"{checkpoint_dir(spark)}/{name}"
