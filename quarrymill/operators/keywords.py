"""Keyphrases: n-gram candidates, their TF-IDF, and a diverse choice by maximal marginal relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import let
from .matching import dot


def ngrams(words: Column, least: int, most: int) -> Column:
    """All runs of ``least`` to ``most`` words, space-joined, with repeats."""

    def runs(w: Column) -> Column:
        of = lambda n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))
        return F.concat(*[of(n) for n in range(least, most + 1)])

    return let(words, runs)


def tfidf(docs: DataFrame, key: list[str], words: Column, least: int = 1, most: int = 2, top: int = 5) -> DataFrame:
    """(key, term, score): the ``top`` terms of each document by count times log(N / df).

    Counts are taken per document and term before anything is shuffled by term, so a common term
    is one row a document, and document frequencies are summed map-side.
    """
    rows = docs.select(*key, F.explode(ngrams(words, least, most)).alias("term")).groupBy(*key, "term").agg(F.count(F.lit(1)).alias("tf"))
    df = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))  # one row
    scored = rows.join(df, "term").join(F.broadcast(n), F.lit(True)).withColumn("score", F.round(F.col("tf") * F.log(F.col("n") / F.col("df")), 6))
    w = Window.partitionBy(*key).orderBy(F.desc("score"), "term")
    return scored.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top).select(*key, "term", "score")


def diverse(candidates: Column, number: int, diversity: float) -> Column:
    """Terms chosen one by one: most relevant, less ``diversity`` of its likeness to what is chosen already.

    ``candidates``: array<struct<term string, relevance double, v array<double>>>, vectors of length 1.
    """

    def pick(chosen: Column, _: Column) -> Column:
        left = F.filter(candidates, lambda c: ~F.exists(chosen, lambda x: x["term"] == c["term"]))
        like = lambda c: F.coalesce(F.array_max(F.transform(chosen, lambda x: dot(x["v"], c["v"]))), F.lit(0.0))
        worth = F.transform(left, lambda c: F.struct((F.lit(1 - diversity) * c["relevance"] - F.lit(diversity) * like(c)).alias("s"), c.alias("c")))
        return F.when(F.size(left) > 0, F.array_append(chosen, F.array_max(worth)["c"])).otherwise(chosen)

    none = F.filter(candidates, lambda c: F.lit(False))
    return F.transform(F.aggregate(F.sequence(F.lit(1), F.lit(number)), none, pick), lambda c: c["term"])
