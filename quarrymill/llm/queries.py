"""The registered query of each training-data operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_records, decontamination, language_id, lm_mixing, packing, quality_classifier, quality_rules, secret_scan, sharding, simhash
from ._common import remainder, shared_dir
from .tokens import vocabulary


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held = remainder("doc_id", 3) == 1
    model = language_id.fit(docs.where(~held), "doc_id", "text", "lang")
    return language_id.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=2048)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    ratios = secret_scan.train(secret_scan.default_samples(docs, "doc_id", "text"))
    return secret_scan.digest(secret_scan.scan(docs, ratios))


def op4_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    files = binary_records.write(docs, shared_dir(spark), vocabulary("byte_bpe_50k.json"))
    return binary_records.read(spark, files).drop("ids")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.classes(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, budget=4)
    return rows.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held = remainder("doc_id", 3) == 1
    model = quality_classifier.fit(docs.where(~held), labels.where(~held))
    return quality_classifier.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"), shards=24)
    none = F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = quality_rules.rejected(F.col("failures"), "base")
    kept = ~base & ~quality_rules.rejected(F.col("failures"), "v2")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"), "failures")


def op10_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = remainder("doc_id", 7) == 2
    rows = lm_mixing.score(table(spark, sf_dir, "documents", "doc_id", "text"), ~held)
    return rows.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_secret_scans": op3_secret_scans,
    "op4_binary_records": op4_binary_records,
    "op5_simhash": op5_simhash,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_lm_mixing": op10_lm_mixing,
}

_OP9 = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS x FROM documents),
w AS (SELECT rid, doc_id, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws,
  list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(x, '[^A-Z]', '', 'g')) AS caps, length(regexp_replace(x, '[^!]', '', 'g')) AS bangs
  FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
  + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END)
  + (CASE WHEN 10 * caps > 6 * word_chars THEN 32 ELSE 0 END) + (CASE WHEN 2 * bangs > n_words THEN 64 ELSE 0 END) AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
"""

#: Operators whose result SQL expresses; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op9_quality_rules": _OP9}
