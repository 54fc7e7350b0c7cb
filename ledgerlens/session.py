"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ledgerlens", **conf: str) -> SparkSession:
    """Session with the settings the operators are tested under."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def task_count(spark: SparkSession) -> int:
    """How many tasks one shuffle runs: the unit all fair shares are measured in."""
    started = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(started or spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver did; a cluster gets it by --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    held = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([p for p in held if p] + [root])


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session, else a folder in its warehouse.

    A session with executors on other machines must name one of the two on a shared store.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        if not context.master.startswith("local") and folder.startswith(("file:", "/")):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
