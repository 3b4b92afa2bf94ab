"""Supervised subword-embedding classifier of document quality.

Hashed word and character n-gram vectors are averaged per document and fed to a softmax
output; vectors and output weights are trained together by numpy stochastic gradient
descent on a bounded sample of labelled rows (``max_train_docs``), by the gradient of the averaged
softmax. Pairs of words are counted where a word follows itself, all in one bucket of their own:
hashed one by one, pairs of unseen words would say nothing. Since the average and the output layer
are linear, scoring gathers one logit per feature bucket.

Null texts count as empty; an empty text gets the score of the output bias. Very long texts are
taken in pieces that begin at words. With labels of one class only, or none, every score is 0.5
plus the bias learned (0.5 without labels). An id with several labels takes the least; of rows
that share an id the text with the smallest hash trains. Repeated rows are each scored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import bounded_sample, code_points, session, slices, trimmed

BUCKETS = 1 << 17
#: The bucket of words that repeat the one before them; no other feature falls into it.
REPEAT = BUCKETS
#: Characters of a text that are worked on at once.
PIECE = 1_000_000


#: Rates of the vectors and of the bias, over that of the output weights.
EMBED, BIAS = 20.0, 0.1


def buckets(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets, and place and length of each: character 3- and 5-grams, words, and words said twice in a row."""
    n = len(points)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = points.astype(np.uint32)
    out, at, long = [], [], []
    with np.errstate(over="ignore"):
        for size, seed in ((3, 0x9E3779B1), (5, 0x85EBCA77)):
            if n >= size:
                h = np.full(n - size + 1, seed, np.uint32)
                for k in range(size):
                    h = (h ^ p[k : n - size + 1 + k]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(16)
                h *= np.uint32(0x7FEB352D)
                out.append(h >> np.uint32(15))
                at.append(np.arange(n - size + 1))
                long.append(np.full(n - size + 1, size))
        space = (p == 32) | ((p >= 9) & (p <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        first, last = edge[0::2], edge[1::2]
        weight = (p ^ np.uint32(0x2545F491)) * np.uint32(0xC2B2AE3D)
        spread = weight * (np.uint32(1) + (weight >> np.uint32(7)))
        if len(first):
            place = np.arange(n, dtype=np.uint32)
            begin = np.repeat(first, last - first)
            inside = np.flatnonzero(~space)
            mixed = spread[inside] * (np.uint32(2) * (place[inside] - begin.astype(np.uint32)) + np.uint32(1))
            mixed ^= mixed >> np.uint32(13)
            mixed *= np.uint32(0x2C1B3C6D)
            h = np.add.reduceat(mixed, np.concatenate(([0], np.cumsum(last - first)[:-1])), dtype=np.uint32)
            h ^= h >> np.uint32(16)
            h *= np.uint32(0x297A2D39)
            again = np.flatnonzero(h[1:] == h[:-1])
            out += [h >> np.uint32(15), np.full(len(again), REPEAT, np.uint32)]
            at += [first, first[again]]
            long += [last - first, last[again + 1] - first[again]]
    return np.concatenate(out).astype(np.int64), np.concatenate(at), np.concatenate(long)


def pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """The feature buckets of one text, ``PIECE`` characters or a little more at a time; together those of the whole."""
    if len(points) <= PIECE:
        yield buckets(points)[0]
        return
    space = (points == 32) | ((points >= 9) & (points <= 13))
    words = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))  # where words start
    a = 0
    while a < len(points):
        k = int(np.searchsorted(words, a + PIECE))
        b = int(words[k]) if k < len(words) else len(points)
        # what starts before b may reach into the next word, or four characters on
        reach = np.append(words[k + 1 : k + 7], len(points))
        stop = int(reach[min(5, len(reach) - 1)])
        h, at, _ = buckets(points[a:stop])
        yield h[at < b - a]
        a = b


class Model:
    """The document logit is ``logit[buckets].mean() + bias``: embeddings times the softmax weights' difference."""

    def __init__(self, logit: np.ndarray, bias: float):
        self.logit, self.bias = logit.astype(np.float32), float(bias)


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 8, rate: float = 1.0, seed: int = 1) -> Model:
    """SGD over (label, buckets, counts), one document a step, with a linearly falling rate; classes weigh equally.

    A feature's share of its document is small, so vectors move at ``EMBED`` times the rate of the output.
    """
    rng = np.random.default_rng(seed)
    embed = ((rng.random((BUCKETS + 1, dim)) - 0.5) / dim).astype(np.float32)
    weight, bias = rng.normal(0, 0.1, (2, dim)), np.zeros(2)
    share = np.bincount([y for y, _, _ in samples], minlength=2) / max(len(samples), 1)
    if not samples or share.min() == 0:
        return Model(np.zeros(BUCKETS + 1), 0.0)
    step, steps = 0, epochs * len(samples)
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            y, idx, n = samples[i]
            lr = rate * (1 - step / steps)
            step += 1
            w = (n / max(n.sum(), 1)).astype(np.float32)
            mean = w @ embed[idx] if len(idx) else np.zeros(dim)
            z = weight @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= 0.5 / share[y]
            back = p @ weight
            weight -= lr * np.outer(p, mean)
            bias -= lr * BIAS * p
            if len(idx):
                embed[idx] -= np.outer(w, lr * EMBED * back).astype(np.float32)
    return Model(embed @ (weight[1] - weight[0]), bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train_docs: int = 3000) -> Model:
    """Trains on at most ``max_train_docs`` labelled rows, picked by hash, in one task; only the model reaches the driver."""
    session(docs)
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = marked.join(texts.select("id"), "id", "left_semi")
    ids = bounded_sample(known, "id", ["y"], max_train_docs)
    sample = texts.join(F.broadcast(ids), "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))

    @trimmed
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, y, t in zip(pdf["id"], pdf["y"], pdf["text"], strict=True):
                total = np.zeros(BUCKETS + 1, np.int64)
                for h in pieces(code_points([t if isinstance(t, str) else ""])[0]):
                    total += np.bincount(h, minlength=BUCKETS + 1)
                idx = np.flatnonzero(total)
                n = total[idx]
                out.append((key, y, idx.astype(np.uint32).tobytes(), n.astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["id", "y", "idx", "n"])

    @trimmed
    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for pdf in batches for r in pdf.itertuples(index=False)]
        rows.sort(key=lambda r: r.id)
        model = train([(r.y, np.frombuffer(r.idx, np.uint32), np.frombuffer(r.n, np.uint32)) for r in rows])
        yield pd.DataFrame({"logit": [model.logit.tobytes()], "bias": [model.bias]})

    features = sample.mapInPandas(count, f"id {dict(sample.dtypes)['id']}, y int, idx binary, n binary")
    got = features.repartition(1).mapInPandas(learn, "logit binary, bias double").first()
    return Model(np.frombuffer(got["logit"], np.float32), got["bias"]) if got else train([])


def _probabilities(texts: list[str | None], m: Model) -> np.ndarray:
    texts = [t if isinstance(t, str) else "" for t in texts]
    z = np.full(len(texts), m.bias)
    for i, j in slices(np.array([len(t) for t in texts], np.int64)):
        points, starts = code_points(texts[i:j])
        if len(points) > PIECE:  # one long text
            sums = [(float(m.logit[h].sum(dtype=np.float64)), len(h)) for h in pieces(points)]
            z[i] += sum(x for x, _ in sums) / max(sum(n for _, n in sums), 1)
            continue
        h, at, long = buckets(points)
        # a feature that reaches into the next text belongs to neither
        doc = np.searchsorted(starts, at, side="right") - 1
        good = at + long <= starts[doc + 1]
        total = np.bincount(doc[good], weights=m.logit[h[good]], minlength=j - i)
        number = np.bincount(doc[good], minlength=j - i)
        z[i:j] += total / np.maximum(number, 1)
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score and predicted of every row."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    shared = session(docs).sparkContext.broadcast(model)

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = _probabilities(pdf["text"].tolist(), shared.value)
            yield pd.DataFrame({id_col: pdf[id_col], "score": p, "predicted": (p >= 0.5).astype(np.int32)})

    return rows.mapInPandas(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, score double, predicted int")


def accepted(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score reaches ``least``, with all their columns."""
    shared = session(docs).sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_probabilities(batch.column(at).to_pylist(), shared.value) >= least))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
