"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators count on. Skewed join partitions are split by their measured size; the
# "force" setting keeps that split even where a later stage would then need one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session; sizes and partition counts stay the cluster's choice."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    That is the folder every executor can reach; without one there is nowhere to write.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{root.rstrip('/')}/colonnade/{label}-{uuid.uuid4().hex}"
