"""Incremental augmentation as Structured Streaming.

A file stream of records is joined against what the ledger holds; each micro-batch appends its
augment rows, then its status rows. The batch id is written with them, so a batch that is
replayed after a failure finds its own rows and adds none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def augment_stream(
    spark: SparkSession, source: str, schema, out: str, key: str, process: str, derive: Callable[[DataFrame], DataFrame], max_files: int | None = None
) -> StreamingQuery:
    """Runs ``derive`` (records to record_id, property, value) over files not seen yet, then stops.

    Writes ``out``/augments and ``out``/status, partitioned by process.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def handle(batch: DataFrame, batch_id: int) -> None:
        done = _read(spark, f"{out}/status", "record_id string, status string, process string, batch long")
        mine = done.where(F.col("process") == process).where(F.col("batch") != batch_id).select(F.col("record_id").alias("__d")).distinct()
        fresh = batch.dropDuplicates([key]).join(mine, F.col(key).cast("string") == F.col("__d"), "left_anti")
        rows = derive(fresh).select("record_id", "property", "value", F.lit(process).alias("process"), F.lit(batch_id).cast("long").alias("batch"))
        status = fresh.select(F.col(key).cast("string").alias("record_id"), F.lit("success").alias("status"), F.lit(process).alias("process"), F.lit(batch_id).cast("long").alias("batch"))
        # a replayed batch overwrites its own partition; status comes last
        for name, part in (("augments", rows), ("status", status)):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("process", "batch").parquet(f"{out}/{name}")

    return reader.parquet(source).writeStream.foreachBatch(handle).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def windowed_counts(events: DataFrame, time: str, late: str, size: str, by: str) -> DataFrame:
    """Counts per tumbling window and key; events later than ``late`` are dropped. Works on streams and tables alike."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
