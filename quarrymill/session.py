"""The session settings that the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive plans with skew handling; broadcasts only below a measured size; UTC; bounded Arrow batches.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(app: str = "quarrymill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` override them.

    On a cluster give spark.checkpoint.dir a folder that all executors share, and
    spark.sql.shuffle.partitions some three times the cores: AQE merges what is too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | settings).getOrCreate()
