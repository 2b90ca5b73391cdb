"""Session settings the package is written for, and the shared folder it writes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and wall-clock (UTC) timestamps.

    ``spark.sql.shuffle.partitions`` is left to the cluster's own setting: adaptive execution
    merges small partitions, so it only has to be high enough for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local run, such as a test, may leave it unset; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tallyloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
