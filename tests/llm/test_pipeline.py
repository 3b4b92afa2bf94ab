"""The pipeline over a small corpus: each stage's decisions, checked by hand."""

import random

import pytest

import corpus_pipeline as C
from quarrymill.llm import packing


def corpus(spark, path, empty=False):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    words = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [words(30) for _ in range(5)]
    docs = [(i, words(rng.randint(80, 300))) for i in range(120)]
    docs += [(200 + i, " ".join(rng.choice(["###$$", "|buy|", "%%%", "&&&!!"]) for _ in range(90))) for i in range(40)]
    docs += [(300, docs[3][1]), (301, docs[4][1] + " " + vocab[0]), (302, words(40) + " " + items[2] + " " + words(40))]
    docs += [(303, words(90) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + words(9)), (304, None), (305, "")]
    docs = [] if empty else docs
    spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 120), 0) for i, _ in docs if i < 300], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return dict(docs)


def test_stages(spark, tmp_path):
    texts = corpus(spark, str(tmp_path))
    docs = first = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for k, (_, stage) in enumerate(C.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == first.columns
        docs.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert left[0] >= set(range(120)) | {300, 301, 302, 303} and not left[0] & set(range(200, 240))
    assert left[0] - left[1] >= {300} and left[1] >= set(range(120)) | {302, 303}
    assert left[1] - left[2] == {302} and left[3] == left[2]
    for r in docs.collect():
        want = texts[r["doc_id"]]
        if r["doc_id"] == 303:
            assert "04dbebab" not in r["text"] and "[SECRET]" in r["text"] and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == want and r["n_chars"] == len(want or "")
    got = C.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == left[3]
    hist = {}
    for r in got:
        hist[r["length"]] = hist.get(r["length"], 0) + 1
    assert len({r["sequence_id"] for r in got}) == sum(b.count for b in packing.solve(hist, 2048))


def test_empty_corpus(spark, tmp_path):
    corpus(spark, str(tmp_path), empty=True)
    assert C.run(spark, str(tmp_path)).count() == 0


def test_each_stage_starts_with_little_memory(monkeypatch):
    def stop(df):
        raise InterruptedError

    monkeypatch.setattr(C, "tidied", stop)
    for _, stage in C.STAGES:
        with pytest.raises(InterruptedError):
            stage(None, None, "")
