"""The corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents:
stages 1 to 3 drop rows, stage 4 rewrites texts, and stage 5 returns the packed pieces.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import decontamination, packing, quality_classifier, secret_scan, simhash
from quarrymill.llm._common import staged, tidied
from quarrymill.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality_classifier.fit(docs, labels)
    return quality_classifier.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id."""
    return simhash.keep_one(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or reworded."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and n_chars counted again."""
    ratios = secret_scan.train(secret_scan.default_samples(docs, "doc_id", "text"))
    found = secret_scan.scan(docs, ratios, keep=docs.columns)
    text = secret_scan.redact(F.coalesce("text", F.lit("")), F.col("found"))
    changed = found.withColumn("text", F.when(F.size("found") > 0, text).otherwise(F.col("text")))
    size = F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", size).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with the sequence and place of each."""
    return packing.pack(docs.select("doc_id", "text"), vocabulary("byte_bpe_50k.json"), capacity=2048)


def after_others(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that starts with the memory that it needs itself, not with what the stage before it held."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(spark, tidied(docs), sf_dir)

    return run


STAGES = [
    (name, after_others(stage))
    for name, stage in (("quality_classifier", quality), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", leaks), ("secret_scans", secrets), ("best_fit_packing", pack))
]

#: Trained models and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
