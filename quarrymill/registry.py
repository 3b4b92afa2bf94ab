"""Registered queries and the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt over all cores by ``key``: a file is read by no more tasks than it has row groups, however much each row costs."""
    tasks = max(rows.rdd.getNumPartitions(), 3 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, key)
