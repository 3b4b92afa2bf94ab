"""Queries of the streaming operators, on the table form of the same expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .streaming.ledger import windowed_counts


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hourly_events(spark: SparkSession, sf: str) -> DataFrame:
    return windowed_counts(table(spark, sf, "events"), "ts", "1 hour", "1 hour", "event_type")
