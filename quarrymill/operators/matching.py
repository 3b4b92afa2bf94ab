"""Terms against a vocabulary: dictionaries, addresses, exact and fuzzy labels, vectors, cascades.

Concepts carry their position, since the first concept wins ties.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import present


def dictionary(rows: DataFrame, column: str, mapping: DataFrame, alias: str) -> DataFrame:
    """``rows`` with the target of each source label, whatever its case; the last of repeated sources counts, an empty target is NULL."""
    one = mapping.select(F.lower("source_label").alias("__s"), F.when(F.col("target_label") != "", F.col("target_label")).alias("__t"), "pos")
    one = one.groupBy("__s").agg(F.max_by("__t", "pos").alias(alias))
    return rows.join(one, F.lower(column) == F.col("__s"), "left").drop("__s")


def exact(subjects: DataFrame, concepts: DataFrame, subject_id: str, key: Column) -> DataFrame:
    """(subject, concept, label): equal labels, whatever the case; the first concept wins. ``concepts``: concept, pos, label."""
    left = subjects.select(F.col(subject_id).alias("subject"), F.lower(key).alias("__key")).where(present(F.col("__key")))
    hit = left.join(concepts, F.col("__key") == F.lower("label"))
    return hit.groupBy("subject").agg(F.min_by(F.struct("concept", "label"), F.struct("pos", "label")).alias("c")).select("subject", "c.concept", "c.label")


def fuzzy_scores(keys: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """(key, concept, pos, label, score) for all pairs of distinct keys and labels that score ``least`` or more.

    A score of t needs lengths within a factor of (200 - t) / t, so each label is dealt to the key
    lengths it can reach and the join is an equi-join on length, no nested loop. Pairs are scored in
    Arrow batches, with one machine word operation per character of a label.
    """
    t = least - 0.5
    short, long = t / (200 - t), (200 - t) / t
    n = F.length("label")
    reach = F.sequence(F.ceil(n * short).cast("int"), F.floor(n * long).cast("int"))
    dealt = labels.where(n > 0).withColumn("__n", F.explode(reach))
    own = keys.select("key").where(F.length("key") > 0).distinct().withColumn("__n", F.length("key"))
    pairs = own.join(dealt, "__n").withColumn("score", F.pandas_udf(_scores, "int")("key", "label"))
    return pairs.where(F.col("score") >= least).select("key", "concept", "pos", "label", "score")


def _scores(a: pd.Series, b: pd.Series) -> pd.Series:
    """``similarity`` of pairs: the common subsequence a bit per character of ``a``."""
    places: dict[str, dict[str, int]] = {}
    out = []
    for x, y in zip(a, b, strict=True):
        masks = places.get(x)
        if masks is None:
            masks = places[x] = {}
            for i, c in enumerate(x):
                masks[c] = masks.get(c, 0) | 1 << i
        full = v = (1 << len(x)) - 1
        for m in map(masks.get, filter(masks.__contains__, y)):
            u = v & m
            v = (v + u | v - u) & full
        out.append(round(200.0 * (len(x) - v.bit_count()) / (len(x) + len(y))))  # halves to even
    return pd.Series(out, dtype="int32")


def best_label(scored: DataFrame, by: list[str]) -> DataFrame:
    """The best label per ``by``: highest score, then first concept, then label."""
    rest = [c for c in scored.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct(-F.col("score"), F.col("pos"), F.col("label")))
    return scored.groupBy(*by).agg(best.alias("__r")).select(*by, "__r.*")


def cascade(subjects: DataFrame, stages: list[tuple[str, DataFrame]], subject_id: str) -> DataFrame:
    """(subject, concept, method): each stage only sees what the stages before left over; unmatched subjects stay, with NULL."""
    rest = subjects.select(F.col(subject_id).alias("subject"))
    everyone = rest
    found = None
    for name, stage in stages:
        hit = rest.join(stage.select("subject", "concept"), "subject").withColumn("method", F.lit(name))
        found = hit if found is None else found.unionByName(hit)
        rest = rest.join(stage.select("subject"), "subject", "left_anti")
    return everyone.join(found, "subject", "left").withColumn("method", F.coalesce("method", F.lit("no_match")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


#: Queries and corpus rows that one task of ``top_k`` holds, and pairs that it scores at once.
QUERY_BLOCK, CORPUS_BLOCK, PAIRS = 2048, 65_536, 1 << 21


def nearest(a: pd.DataFrame, b: pd.DataFrame, k: int, floor: float) -> pd.DataFrame:
    """``top_k`` of one block of queries and one of corpus rows (id, v), without ranks."""
    if not len(a) or not len(b):
        return pd.DataFrame({"query": [], "vec": [], "score": []})
    unit = lambda df: (x := np.stack(df["v"].to_numpy()).astype(float)) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    x, y = unit(a), np.ascontiguousarray(unit(b).T)
    own, other = a["id"].to_numpy(), b["id"].to_numpy()
    least, out = max(floor, -1.0), []
    step = max(1, PAIRS // len(b))
    for i in range(0, len(a), step):
        s = x[i : i + step] @ y
        np.copyto(s, -2.0, where=np.isnan(s))
        s[own[i : i + step, None] == other] = -2.0  # a query doesn't find itself
        # scores count rounded: what is under the k-th by more than a rounding isn't among the k best
        bound = np.maximum(np.partition(s, -k, axis=1)[:, -k] if k < len(b) else least, least) - 2e-6
        r, c = np.nonzero(s >= np.reshape(bound, (-1, 1)))
        score = np.round(s[r, c], 6)
        order = np.lexsort((other[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        good = (rank < k) & (score >= least)
        out.append(pd.DataFrame({"query": own[i + r[good]], "vec": other[c[good]], "score": score[good]}))
    return pd.concat(out)


def top_k(queries: DataFrame, corpus: DataFrame, k: int, floor: float) -> DataFrame:
    """(query, vec, score, rank): the k nearest by cosine at ``floor`` or over, of all of ``corpus`` (id, v), for a stated set of queries (id, v).

    Queries and corpus are cut into blocks by hash; each pair of blocks is one task of bounded
    size, which returns k rows per query at most, so what moves grows with queries and blocks,
    not with pairs, and nothing is collected. A task scores ``PAIRS`` pairs at once and sorts only
    those that can be among the k best, so its memory is that of its rows.
    """
    n_queries, n_corpus = (-(-max(df.count(), 1) // size) for df, size in ((queries, QUERY_BLOCK), (corpus, CORPUS_BLOCK)))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "v", block(n_queries).alias("q")).withColumn("c", every(n_corpus))
    right = corpus.select("id", "v", block(n_corpus).alias("c")).withColumn("q", every(n_queries))

    near = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInPandas(lambda a, b: nearest(a, b, k, floor), "query long, vec long, score double")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    return near.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
