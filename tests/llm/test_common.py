"""Shared helpers: bounded picks, word hashes and slices."""

import gc

import numpy as np
from pyspark.sql import functions as F

from quarrymill.llm import _common as C


def test_smallest_is_exact_beyond_its_bound(spark):
    rows = spark.range(20_000).withColumn("h", F.xxhash64(F.lit(7), F.col("id").cast("string")))
    want = [r["id"] for r in rows.orderBy("h", "id").limit(300).collect()]
    got = C.smallest(rows, F.xxhash64(F.lit(7), F.col("id").cast("string")), 300, "id")
    assert [r["id"] for r in got.orderBy("h").collect()] == want
    assert C.bounded_sample(rows.withColumn("x", F.lit(1)), "id", ["x"], 50).count() == 50
    assert C.smallest(rows.limit(0), F.col("h"), 5, "id").count() == 0


def test_word_hashes_tell_words_apart():
    words = [f"w{i}" for i in range(5000)] + ["", "a", "aa", "ab", "ba", "é", "e"]
    data, starts = C.utf8(words * 2)
    a, b = C.word_spans(data)
    h = C.word_hashes(data, a, b)
    assert len(a) == 2 * (len(words) - 1) and len(set(h.tolist())) == len(words) - 1
    assert (h[: len(words) - 1] == h[len(words) - 1 :]).all()


def test_slices_cover_all_rows():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(0, 30, rng.integers(0, 40))
        cuts = list(C.slices(n, 50))
        assert [i for a, b in cuts for i in range(a, b)] == list(range(len(n)))
        assert all(b - a == 1 or n[a:b].sum() <= 50 for a, b in cuts)


def test_scratch_folder_is_refused_on_a_cluster_and_discarded(spark):
    import os

    import pytest

    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(ValueError):
        C.shared_dir(Session())
    made = C.staged(spark.range(3))
    assert made.count() == 3
    path = C._MADE[-1].removeprefix("file://")
    assert os.path.isdir(path)
    held = C._MADE[:-1]
    C._MADE[:] = C._MADE[-1:]
    C.discard(spark)
    assert not os.path.exists(path) and not C._MADE
    C._MADE[:] = held


def test_a_worker_keeps_tables_of_one_module_alone():
    C._powers(C._P, 10)
    C.kept_by("a")
    C._powers(C._P, 10)
    C.kept_by("a")
    assert C._POWERS
    C.kept_by("b")
    assert not C._POWERS


def test_executors_give_back_heap(spark):
    held = spark._jvm.java.lang.Object()
    weak = spark._jvm.java.lang.ref.WeakReference(held)
    df = spark.range(3)
    del held
    gc.collect()
    assert C.tidied(df) is df  # here the executor is the driver
    assert weak.get() is None
