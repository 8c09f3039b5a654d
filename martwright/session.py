"""Session set-up and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "martwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Checkpoints of row ids go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Recording the call site of every Column makes building a plan several times slower.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they can see it."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or the warehouse if unset.

    A cluster must name it, as its warehouse may be a default nobody meant to share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared"


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/run-{run}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; see `clean_run`."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_run(spark: SparkSession) -> None:
    """Remove all tables that this application wrote between its steps.

    For the caller's end: no DataFrame that an operator returned can be read after it.
    """
    remove(spark, run_folder(spark))


def enable_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, in whatever file system it lies."""
    java = spark.sparkContext._jvm
    target = java.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
