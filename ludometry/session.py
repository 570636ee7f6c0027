"""Session settings and the shared folder for cut lineage and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "ludometry", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this library's settings; master and sizes come from the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session, as in tests, may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used twice."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write to the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
