"""What a task holds and how often an expression is evaluated."""

import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quarrymill import queries_space
from quarrymill.functions import places
from quarrymill.operators import matching as M


def test_nearest_holds_rows_not_pairs():
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(20_000, 8)), 1)
    v[5_000:10_000] = v[:5_000]  # ties
    b = pd.DataFrame({"id": rng.permutation(len(v)), "v": list(v)})
    a = b.iloc[:600]
    tracemalloc.start()
    got = M.nearest(a, b, 15, 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(a) * len(b), peak  # one matrix of all pairs alone takes this
    unit = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    want = set()
    for x, own in zip(unit[:600:20], a["id"][::20], strict=True):
        s = np.round(unit @ x, 6)
        order = [j for j in np.lexsort((b["id"], -s)) if b["id"][j] != own][:15]
        want |= {(own, b["id"][j], s[j]) for j in order if s[j] >= 0.1}
    some = got[got["query"].isin(a["id"][::20])]
    assert set(some.itertuples(index=False, name=None)) == want and len(some) == len(want)


def test_nearest_of_few_rows():
    b = pd.DataFrame({"id": [1, 2, 3, 4], "v": [[1.0, 0.0], [0.0, 0.0], [1.0, float("nan")], [1.0, 1.0]]})
    assert M.nearest(b.iloc[:1], b, 15, 0.1).to_numpy().tolist() == [[1, 4, round(0.5**0.5, 6)]]
    assert len(M.nearest(b.iloc[:0], b, 15, 0.1)) == 0 and len(M.nearest(b.iloc[:1], b, 15, 2.0)) == 0


def test_coverage_is_evaluated_once_and_on_all_cores(spark):
    df = queries_space.multi_country_coverage(spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism  # customer is one row group
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 6 and plan.count("from_json(") == 1


def test_terms_stand_alone(spark):
    texts = ["ukraine uk", "xuk ukx u.k. u.k", "eu-wideeu eu28 (2013-2020)", "españa, the netherlands", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", places.scan(F.col("t")).alias("s")).orderBy("i").collect()
    got = [None if r["s"] is None else (r["s"]["concrete"], r["s"]["countries"]) for r in rows]
    assert got == [([], ["ukraine", "united kingdom"]), ([], ["united kingdom"]), (["eu28 (2013-2020)"], []), ([], ["netherlands", "spain"]), None, None]
