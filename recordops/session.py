"""Session settings and shared folders."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Joins here are written so that the hot side of a skewed key is a plain shuffle
# stage that adaptive execution can split. Forcing the split keeps it on when a
# later step would have liked to reuse the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the session's executors share; there is no default, since a local one would lose files."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
