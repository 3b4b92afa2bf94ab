"""Language identification of mixed-language text.

Script ranges narrow the candidate languages of each word, a character-trigram model gives
each word a score per candidate, and Viterbi over the words with a switching penalty labels
spans. The model is fitted on a bounded sample of labelled rows (``max_train_docs``);
every whole text is labelled.

Null text or text without a letter: ``und``, score 0, no spans. A text in a script that no language
was seen in gets the nearest language with score 0. Languages of equal share: the first in
alphabetic order. Repeated rows are each labelled, and each learned from if they are in the sample.
Empty tables give empty results; without any labelled row every text is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bounded_sample, code_points, lower_same_length, session, slices, trimmed

BUCKETS = 1 << 16
#: Starts of Unicode blocks and the script they belong to (public block chart); the rest is "other".
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0250, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "odia"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"),
    (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x323B0, "other"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
_TABLE: list[np.ndarray] = []


def script_table() -> np.ndarray:
    """For each code point: 0 if it is no letter or mark, else 1 + its script."""
    if not _TABLE:
        n = 0x323B0  # past the last letters
        letters = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(n)), bool, n)
        at = np.searchsorted([a for a, _ in SCRIPT_RANGES], np.arange(n), side="right") - 1
        ids = np.array([1 + SCRIPTS.index(s) for _, s in SCRIPT_RANGES], np.uint8)[at]
        table = np.where(letters, ids, 0).astype(np.uint8)
        table[[c for c in range(n) if letters[c] and unicodedata.category(chr(c))[0] == "M" and c < 0x370]] = 0
        _TABLE.append(table)
    return _TABLE[0]


def features(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of letters, trigram bucket at each, and of each word (a run of one script) its first letter and script."""
    table = script_table()
    script = table[np.minimum(points, len(table) - 1)]
    at = np.flatnonzero(script)
    if not len(at):
        return at, at, at, at
    p, s = points.astype(np.uint32), script
    same = np.zeros(len(p) + 1, bool)
    same[1:-1] = (s[1:] == s[:-1]) & (s[1:] > 0)
    cur = p[at]
    before = np.where(same[at], p[at - 1], np.uint32(1))
    after = np.where(same[at + 1], p[np.minimum(at + 1, len(p) - 1)], np.uint32(2))
    with np.errstate(over="ignore"):
        h = before * np.uint32(0x9E3779B1) + cur * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h >>= np.uint32(16)
    first = np.flatnonzero(~same[at])
    return at, h.astype(np.int64), first, s[at[first]]


class Model:
    """Log-probabilities of trigrams per language and the languages seen in each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, smooth: float = 0.5, rare: float = 1e-3):
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        logp = np.log((counts + smooth) / (total + smooth * BUCKETS)) if len(langs) else np.zeros((0, BUCKETS))
        self.table = np.ascontiguousarray((logp - logp.mean(0, keepdims=True) if len(langs) else logp).T.astype(np.float32))
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1) if len(langs) else scripts
        allowed = (share > rare).T
        self.banned = (~allowed & allowed.any(1, keepdims=True)).astype(np.float32) * -1e4
        self.known = allowed


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_train_docs: int = 8192) -> Model:
    """Counts trigrams and scripts per language over the texts of at most ``max_train_docs`` labelled rows."""
    session(docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.trim("lang") != ""))
    ids = bounded_sample(rows.select("id", "lang"), "id", ["lang"], max_train_docs).select("id")
    sample = rows.join(F.broadcast(ids), "id").where(F.col("text").isNotNull())

    @trimmed
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, group in pdf.groupby("lang"):
                texts = [lower_same_length(t) for t in group["text"]]
                for i, j in slices(np.array([len(t) for t in texts])):
                    at, h, first, script = features(code_points(texts[i:j])[0])
                    if len(at):
                        grams[lang] = grams.get(lang, 0) + np.bincount(h, minlength=BUCKETS)
                        length = np.diff(np.append(first, len(at)))
                        scripts[lang] = scripts.get(lang, 0) + np.bincount(script, weights=length, minlength=len(SCRIPTS) + 1)
        for lang, c in grams.items():
            k = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "slot": k, "n": c[k].astype(np.int64)})
            s = np.flatnonzero(scripts[lang])
            yield pd.DataFrame({"lang": lang, "slot": -s, "n": scripts[lang][s].astype(np.int64)})

    got = sample.mapInPandas(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    counts, scripts = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(SCRIPTS) + 1))
    code = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int) if len(got) else np.zeros(0, int)
    slot, n = got["slot"].to_numpy(int), got["n"].to_numpy(float)
    own = slot >= 0
    counts[code[own], slot[own]] = n[own]
    scripts[code[~own], -slot[~own]] = n[~own]
    return Model(langs, counts, scripts)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best label per word: sum of scores less ``penalty`` for each change of label."""
    n, k = scores.shape
    back = np.zeros((n, k), np.int16)
    best = scores[0].astype(np.float64)
    own = np.arange(k)
    for t in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - penalty
        back[t] = np.where(stay, own, top)
        best = np.where(stay, best, best[top] - penalty) + scores[t]
    path = np.zeros(n, np.int64)
    path[-1] = int(best.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def label_words(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Viterbi's path, without the recursion where one label is provably best throughout.

    If no run of words gains more than half the penalty under another label than under the
    overall best one, each departure costs at least what it gains.
    """
    top = int(scores.sum(0, dtype=np.float64).argmax())
    gain = np.cumsum(scores - scores[:, top : top + 1], axis=0, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
    low[1:] = low[:-1].copy()
    low[0] = 0
    if (gain - low).max() <= penalty / 2:
        return np.full(len(scores), top)
    return viterbi(scores, penalty)


def label_text(points: np.ndarray, starts: np.ndarray, model: Model, penalty: float) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """Per text: language, its share of the letters (those in scripts it was seen in), and spans (language, start, end) in code points."""
    at, h, first, script = features(points)
    n = len(starts) - 1
    if not len(at) or not model.langs:
        return [("und", 0.0, [])] * n
    scores = np.add.reduceat(model.table[h], first, axis=0) + model.banned[script]
    length = np.diff(np.append(first, len(at)))
    begin, end = at[first], at[np.append(first[1:], len(at)) - 1] + 1
    bounds = np.searchsorted(begin, starts)
    out = []
    for d in range(n):
        a, b = bounds[d], bounds[d + 1]
        if a == b:
            out.append(("und", 0.0, []))
            continue
        path = label_words(scores[a:b], penalty)
        letters = np.bincount(path, weights=length[a:b], minlength=len(model.langs))
        top = int(letters.argmax())
        own = float(length[a:b][(path == top) & model.known[script[a:b], top]].sum())  # in scripts that the language was seen in
        cut = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [b - a]))
        spans = [(model.langs[path[x]], int(begin[a + x] - starts[d]), int(end[a + y - 1] - starts[d])) for x, y in zip(cut[:-1], cut[1:], strict=True)]
        out.append((model.langs[top], own / float(letters.sum()), spans))
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", penalty: float = 12.0) -> DataFrame:
    """``id_col``, lang_pred, score and spans of every row of ``docs``."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)[id_col]
    shared = session(docs).sparkContext.broadcast(model)

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            texts = [lower_same_length(t) if isinstance(t, str) else "" for t in pdf["text"]]
            got = []
            for i, j in slices(np.array([len(t) for t in texts], np.int64)):
                points, starts = code_points(texts[i:j])
                got += label_text(points, starts, m, penalty)
            yield pd.DataFrame({
                id_col: pdf[id_col], "lang_pred": [g[0] for g in got], "score": [g[1] for g in got],
                "spans": [[{"lang": x, "start": a, "end": b} for x, a, b in g[2]] for g in got],
            })

    return rows.mapInPandas(run, f"`{id_col}` {kind}, lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>")
