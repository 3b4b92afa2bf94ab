"""Each registered query over a small corpus: columns, rows, held-out marks and empty tables."""

import zlib

import pytest

from quarrymill.llm import queries as Q

from .test_pipeline import corpus

COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op3_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_binary_records": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_simhash": ["doc_id", "fingerprint", "component_id"],
    "op6_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op7_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op8_decontamination": ["doc_id", "item_id"],
    "op9_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op10_lm_mixing": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}
HELD = {"op1_language_id": (3, 1), "op6_quality_classifier": (3, 1), "op10_lm_mixing": (7, 2)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    return path, corpus(spark, path)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, folder, name):
    path, texts = folder
    got = Q.QUERIES[name](spark, path)
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    rows = got.collect()
    if name == "op8_decontamination":
        assert {(r["doc_id"], r["item_id"]) for r in rows} == {(302, 2)}
        return
    ids = {r["doc_id"] for r in rows}
    assert ids == set(texts) and (name == "op2_best_fit_packing" or len(rows) == len(texts))
    if name in HELD:
        n, k = HELD[name]
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == k) for r in rows)


def test_empty_tables(spark, tmp_path):
    corpus(spark, str(tmp_path), empty=True)
    for name, columns in COLUMNS.items():
        got = Q.QUERIES[name](spark, str(tmp_path))
        assert got.columns[: len(columns)] == columns and got.count() == 0, name
