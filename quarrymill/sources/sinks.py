"""Writers: quoted CSV, versioned NDJSON, and the augment and status tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def next_version(spark: SparkSession, path: str, prefix: str = "v") -> int:
    """One more than the highest version below a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return 1 + max([int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit()], default=0)


def versioned_json(rows: DataFrame, path: str) -> int:
    """Writes the next version, as NDJSON; returns its number."""
    n = next_version(rows.sparkSession, path)
    rows.write.json(f"{path}/v{n}")
    return n


def augments(rows: DataFrame, status: DataFrame, path: str, batch: str) -> None:
    """Writes a batch's augment rows, then its status rows, by process: what has no status yet is done again.

    A batch that is written again (after a failure between the two, say) replaces its own rows and no others.
    """
    for part, name in ((rows, "augments"), (status, "status")):
        out = part.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("process", "batch").parquet(f"{path}/{name}")


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a table at ``path``; none where nothing was written yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def append_ignoring(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the table at ``path`` lacks, one row a key; written twice they are there once."""
    types = dict(rows.dtypes)
    have = stored(rows.sparkSession, path, ", ".join(f"`{c}` {types[c]}" for c in rows.columns)).select(*keys)
    rest = [c for c in rows.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r")).select(*keys, "__r.*") if rest else rows.distinct()
    one.join(have, keys, "left_anti").select(*rows.columns).write.mode("append").parquet(path)


def insert_records(records: DataFrame, path: str) -> None:
    """Harvested records into the table of items, by identifier and hash, and into the one that tells duplicates by source."""
    append_ignoring(records, f"{path}/items", ["identifier", "hash"])
    append_ignoring(records.select("identifier", "identifiertype", "source", "hash").distinct(), f"{path}/item_duplicates", ["identifier", "source", "hash"])


def add_sources(sources: DataFrame, path: str) -> None:
    """Sources (name, url, filter, type) under their names in capitals, unless they are known."""
    append_ignoring(sources.withColumn("name", F.upper("name")), path, ["name"])


def status_of(records: DataFrame, key: str, process: str, status: str = "success", details: str | None = None) -> DataFrame:
    return records.select(F.col(key).cast("string").alias("record_id"), F.lit(status).alias("status"), F.lit(process).alias("process"), F.lit(details).cast("string").alias("details"))
