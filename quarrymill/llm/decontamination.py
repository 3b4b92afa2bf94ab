"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words, over all documents, give the TF-IDF weights. The words'
   slots are kept in the shared folder (2 bytes a word), so that texts are read into words once.
2. A distributed randomised SVD of the TF-IDF matrix of passages (those of all documents and all
   items) gives ``rank`` directions, scaled to unit variance: every task returns its part of
   A'(A X), the parts are summed in two levels, the sum is orthonormalised on the driver.
3. Every whole text is cut into blocks of ``BLOCK`` words; windows of 2 and of 5 blocks slide
   over it block by block, and those with a cosine of ``cosine`` or more to an item are candidates.
   So is every passage (a block and the blocks around it, ``ROOM`` more to each side than the item
   has) that holds as many of the item's rarest words as ``overlap`` of the item can't do without:
   none that passes the next step is left out.
4. A candidate counts if the longest common subsequence of words of item and passage covers
   ``overlap`` of the item, and that of the item's answer (its last quarter) ``answer`` of it.

Items are taken in blocks of ``ITEMS``; documents stay where they are and each is judged on
its own, so nothing is shuffled but the statistics. Words are runs of letters and digits, A-Z
lower-cased. Null or empty texts and items match nothing; repeated rows are each judged, and items
that share an id are items each. Of passages with equally many common words the first found is
reported. An empty table
on either side gives no matches, and ``clean`` then keeps every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import KEPT, session, slices, staged, trimmed

SPACE = 1 << 14  # 32 - 18 bits of a word's hash
BLOCK = 12
SCALES = (2, 5)
#: Most words of an item's part.
PART = 60
#: Blocks to each side of a passage beyond those of the item.
ROOM = 2
ITEMS = 4096
CHARS = 1_000_000
#: Words of a passage of the fit.
PASSAGE = 4 * BLOCK
#: Words whose part of A'(A X) one task returns at least, if there are cores enough for less.
TASK_WORDS = 16_000_000
_BLOCKS = 16
_CLASS = np.full(256, 32, np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _CLASS[_c] = _c
for _c in range(65, 91):
    _CLASS[_c] = _c + 32


_VALUE = np.random.Generator(np.random.PCG64(21)).integers(1, 1 << 32, 256, dtype=np.uint32)
_MUL = 0x9E3779B1
_INVERSE = pow(_MUL, -1, 1 << 32)
_POWERS: dict[int, np.ndarray] = {}
KEPT.append(_POWERS)


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        full = np.full(1 << max(10, int(n).bit_length()), base, np.uint32)
        full[0] = 1
        _POWERS[base] = np.multiply.accumulate(full, dtype=np.uint32)
    return _POWERS[base][:n]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """32-bit polynomial hashes of words by prefix sums: enough to compare words of one passage and one item."""
    sums = np.zeros(len(data) + 1, np.uint32)
    np.cumsum(_VALUE[data] * _powers(_MUL, len(data)), out=sums[1:], dtype=np.uint32)
    h = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(16)
    return h * np.uint32(0x85EBCA77)


class Words:
    """The words of some texts: their hashes, the text of each, and their bytes."""

    def __init__(self, texts: list[str | None]):
        raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
        begin = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in raw], out=begin[1:])
        self.data = _CLASS[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], self.data == 32)).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.hashes = _hashes(self.data, self.starts, self.ends)
        self.slot = (self.hashes >> np.uint32(18)).astype(np.int64)
        self.first = np.searchsorted(self.starts, begin)  # of each text, and the end of the last


def cut(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of blocks of ``size`` words, and the first block of each text."""
    number = -(-np.diff(first) // size)
    start = np.concatenate(([0], np.cumsum(number)))
    inside = np.arange(start[-1]) - np.repeat(start[:-1], number)
    return np.repeat(first[:-1], number) + inside * size, start


def frequencies(w: Words, own: np.ndarray) -> np.ndarray:
    """In how many of the texts marked ``own`` each slot occurs."""
    doc = np.repeat(np.arange(len(own)), np.diff(w.first))
    kept = own[doc]
    slot, doc = w.slot[kept].astype(np.uint16), doc[kept]
    order = np.argsort(slot, kind="stable")  # of 16 bits: by counting; a slot's texts stay in order
    slot, doc = slot[order], doc[order]
    fresh = np.ones(len(slot), bool)
    fresh[1:] = (slot[1:] != slot[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(slot[fresh], minlength=SPACE)


def parsed(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(n, df, slot, size) from the texts of both: per task the documents and their frequencies by slot, or the slots of words and the words of each passage."""
    rows = docs.select(F.col("text"), F.lit(True).alias("doc")).unionByName(items.select(F.col("text"), F.lit(False).alias("doc")))

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(SPACE, np.int64), 0
        for pdf in batches:
            texts, own = pdf["text"].tolist(), pdf["doc"].to_numpy(bool)
            for i, j in slices(np.array([len(t) if isinstance(t, str) else 0 for t in texts], np.int64), CHARS):
                w = Words(texts[i:j])
                total += frequencies(w, own[i:j])
                n += int(own[i:j].sum())
                at, _ = cut(w.first, PASSAGE)
                yield pd.DataFrame({"n": [0], "df": [None], "slot": [w.slot.astype(np.uint16).tobytes()], "size": [np.diff(np.append(at, len(w.slot))).astype(np.uint8).tobytes()]})
        if n:
            yield pd.DataFrame({"n": [n], "df": [total.tobytes()], "slot": [None], "size": [None]})

    return staged(rows.mapInPandas(run, "n long, df binary, slot binary, size binary"))


def idf(words: DataFrame) -> np.ndarray:
    """Inverse document frequencies of the hashed words, from all documents (``parsed``)."""
    # one row a task; summed in two levels, so that no task sees all of them
    parts = words.where("df is not null").select("n", "df")
    level = parts.withColumn("g", F.pmod(F.xxhash64("df"), F.lit(64))).groupBy("g").applyInPandas(_add_counts, "n long, df binary")
    rows = level.collect()
    n = sum(r["n"] for r in rows)
    df = sum((np.frombuffer(r["df"], np.int64) for r in rows), np.zeros(SPACE, np.int64))
    return np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.01)


def _add_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"n": [int(pdf["n"].sum())], "df": [sum(np.frombuffer(x, np.int64) for x in pdf["df"]).tobytes()]})


def row_sums(y: np.ndarray, own: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of ``own`` (sorted) and for each the sum of its rows of ``y``: eight at a time, then sums of these until one is left."""
    begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))[: len(own)])
    size = np.diff(np.append(begin, len(own)))
    own, open_ = own[begin], np.arange(len(begin))
    out = np.empty((len(begin), y.shape[1]), y.dtype)
    while True:
        one = size == 1
        begin = np.cumsum(size) - size
        out[open_[one]] = y[row[begin[one]]]
        if one.all():
            return own, out
        row, size, open_ = row[np.repeat(~one, size)], size[~one], open_[~one]
        rank = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        index = np.full((8, int((-(-size // 8)).sum())), len(y))
        index[rank & 7, np.cumsum(rank & 7 == 0) - 1] = row
        y = _taken(np.concatenate([y, np.zeros((1, y.shape[1]), y.dtype)]), index)
        size = -(-size // 8)
        row = np.arange(len(y))


def _taken(table: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each column of ``index`` the sum of these rows of the table."""
    out = np.empty((index.shape[1], table.shape[1]), table.dtype)
    for i in range(0, len(out), 256):
        x = out[i : i + 256]
        held = np.empty_like(x)
        table.take(index[0, i : i + 256], axis=0, out=x, mode="clip")
        for k in range(1, len(index)):
            table.take(index[k, i : i + 256], axis=0, out=held, mode="clip")
            x += held
    return out


def gram_times(slot: np.ndarray, size: np.ndarray, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A'(A x) of the row-normalised TF-IDF matrix A of passages of ``size`` words each, whose slots follow each other."""
    out = np.zeros_like(x)
    weight = np.append(weights, np.float32(0)).astype(np.float32)  # the last slot is none
    table = weight[:, None] * np.concatenate([x, np.zeros((1, x.shape[1]), x.dtype)])
    ends = np.cumsum(size, dtype=np.int64)
    for i in range(0, len(size), 4096):
        n = size[i : i + 4096].astype(np.int64)
        inside = np.arange(int(n.max())) < n[:, None]
        cell = np.full(inside.shape, SPACE, np.uint16)
        cell[inside] = slot[ends[i] - n[0] : ends[i + len(n) - 1]]
        cell.sort(axis=1)
        index = np.ascontiguousarray(cell.T).astype(np.int64)
        # a word's k-th occurrence adds 2 k - 1 squares: together the square of its count
        square, times = np.zeros(len(n), np.float32), np.ones(len(n), np.float32)
        for k in range(len(index)):
            if k:
                times = np.where(index[k] == index[k - 1], times + 2, np.float32(1))
            square += times * weight[index[k]] ** 2
        y = _taken(table, index) / square[:, None]
        order = np.argsort(cell.ravel(), kind="stable")[: int(n.sum())]
        own, sums = row_sums(y, cell.ravel()[order], order // cell.shape[1])
        out[own] += sums * weight[own, None]
    return out


def fit(words: DataFrame, weights: np.ndarray, rank: int = 64, rounds: int = 2) -> np.ndarray:
    """Word slots to latent coordinates of unit variance: randomised subspace iteration over all passages (``parsed``)."""
    rows = words.where("slot is not null").select("slot", "size")
    spark = session(words)
    number = rows.agg(F.coalesce(F.sum(F.length("slot")), F.lit(0))).first()[0] // 2
    # each task's part goes through a shuffle: on many small files fewer tasks run
    rows = rows.coalesce(max(spark.sparkContext.defaultParallelism, -(-number // TASK_WORDS)))
    x = np.random.default_rng(11).normal(size=(SPACE, rank)).astype(np.float32)
    kind = "part int, g int, task int, z binary"

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(z, np.float32).astype(np.float64) for z in pdf.sort_values("task")["z"])
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "g": 0, "task": pdf["g"].iloc[0], "z": [total.astype(np.float32).tobytes()]})

    for k in range(rounds + 1):
        shared = spark.sparkContext.broadcast(x)

        @trimmed
        def part(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            total, task = None, TaskContext.get().partitionId()
            for pdf in batches:
                got = gram_times(np.frombuffer(b"".join(pdf["slot"]), np.uint16), np.frombuffer(b"".join(pdf["size"]), np.uint8), weights, shared.value)
                total = got if total is None else np.add(total, got, out=total)
            for b, z in enumerate(np.split(total, _BLOCKS) if total is not None else ()):
                yield pd.DataFrame({"part": [b], "g": [task % 64], "task": [task], "z": [z.tobytes()]})

        z = np.zeros((SPACE, rank))
        step = SPACE // _BLOCKS
        level = rows.mapInPandas(part, kind).groupBy("part", "g").applyInPandas(add, kind)
        for r in level.groupBy("part").applyInPandas(add, kind).toLocalIterator():
            z[r["part"] * step : (r["part"] + 1) * step] = np.frombuffer(r["z"], np.float32).reshape(step, rank)
        if k < rounds:
            x = np.linalg.qr(z)[0].astype(np.float32)
        else:  # x is orthonormal, z = A'A x: rotate to the singular directions
            value, turn = np.linalg.eigh(x.T.astype(np.float64) @ z)
            spectrum = np.sqrt(np.maximum(value, 1e-9 * max(value.max(), 1e-9)))
            x = (x @ turn / spectrum).astype(np.float32)
    return x * weights[:, None]


def places(a: list) -> dict:
    """For each element the bits of its places in ``a``."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def common(a: list, b: list, masks: dict | None = None) -> int:
    """Length of the longest common subsequence, a bit per element of ``a`` (whose places are ``masks``)."""
    masks = places(a) if masks is None else masks
    full = (1 << len(a)) - 1
    v = full
    for m in map(masks.get, filter(masks.__contains__, b)):
        u = v & m
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Index:
    """The items of a block and everything that judges a text.

    An item is cut into parts of ``PART`` words at most, and each part is searched for with
    windows of both sizes. ``weights`` tell which words are rare.
    """

    def __init__(self, ids: list, texts: list[str], table: np.ndarray, weights: np.ndarray, cosine: float, overlap: float, answer: float):
        w = Words(texts)
        self.ids, self.table = ids, np.concatenate([table, np.zeros((1, table.shape[1]), np.float32)]).astype(np.float32)
        self.cosine, self.overlap, self.answer = cosine, overlap, answer
        self.words = [w.hashes[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.places = [places(x) for x in self.words]
        parts: list[tuple[int, np.ndarray]] = []
        for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            for part in np.array_split(w.slot[a:b], -(-(b - a) // PART)) if b > a else []:
                v = table[part].sum(0)
                if norm := float(np.linalg.norm(v)):
                    parts.append((k, v / norm))
        self.owners = np.array([k for k, _ in parts], np.int64)
        self.queries = np.ascontiguousarray(np.array([v for _, v in parts], np.float32).reshape(-1, table.shape[1]).T)
        self.least, self.room = np.ones(len(ids), np.int64), np.zeros(len(ids), np.int64)
        rare = []
        for k, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            n = b - a
            need = max(int(np.ceil(overlap * n)), 1)
            # a match lacks n - need words at most, so of the n - need + least rarest it has at least ``least``
            self.least[k], self.room[k] = min(need, 1 + n // 8), -(-n // BLOCK) + ROOM
            words = w.hashes[a:b][np.argsort(-weights[w.slot[a:b]], kind="stable")][: n - need + self.least[k]]
            rare.append(np.unique(words).astype(np.int64) << 32 | k)
        pairs = np.sort(np.concatenate([np.zeros(0, np.int64), *rare]).view(np.uint64))
        self.rare, self.rare_first = np.unique((pairs >> np.uint64(32)).astype(np.uint32), return_index=True)
        self.rare_first, self.rare_owner = np.append(self.rare_first, len(pairs)), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.rare >> np.uint32(12)] = True

    def windows(self, blocks: np.ndarray, start: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
        """First blocks of the windows, and their vectors; a text of fewer blocks has one window."""
        n = len(blocks)
        x = np.zeros((max(n - scale + 1, 0), blocks.shape[1]), np.float32)
        for k in range(scale):
            x += blocks[k : k + len(x)]
        first = np.repeat(start[:-1], np.diff(start))
        last = np.repeat(start[1:], np.diff(start))
        at = np.arange(n)
        whole = np.flatnonzero(at + scale <= last)
        short = np.flatnonzero((at == first) & (at + scale > last))
        parts = [x[whole]]
        if len(short):
            ends = last[short]
            parts.append(np.stack([blocks[a:b].sum(0) for a, b in zip(short.tolist(), ends.tolist(), strict=True)]))
        return np.concatenate([whole, short]), np.concatenate(parts)

    def rare_places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of all rare words of items, by item, then place."""
        place = np.flatnonzero(self.maybe[hashes >> np.uint32(12)])
        if not len(place):
            return np.zeros(0, np.int64), place
        word = np.minimum(np.searchsorted(self.rare, hashes[place]), len(self.rare) - 1)
        same = self.rare[word] == hashes[place]
        place, word = place[same], word[same]
        size = self.rare_first[word + 1] - self.rare_first[word]
        owner = self.rare_owner[np.repeat(self.rare_first[word], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        order = np.argsort(owner, kind="stable")
        return owner[order], np.repeat(place, size)[order]

    def sharing(self, owner: np.ndarray, place: np.ndarray, at: np.ndarray, start: np.ndarray, text_of: np.ndarray) -> dict[tuple[int, int], list[list[int]]]:
        """For (text, item) the ranges (first, last) of blocks whose passages hold enough of the item's ``rare_places``."""
        block = np.searchsorted(at, place, side="right") - 1
        i = np.arange(len(owner))
        j = i + self.least[owner] - 1
        i, j = i[j < len(owner)], j[j < len(owner)]
        room = self.room[owner[i]]
        good = (owner[j] == owner[i]) & (text_of[block[j]] == text_of[block[i]]) & (block[j] - block[i] <= 2 * room)
        i, j, room = i[good], j[good], room[good]
        text = text_of[block[i]]
        low, high = np.maximum(block[j] - room, start[text]), np.minimum(block[i] + room, start[text + 1] - 1)
        out: dict[tuple[int, int], list[list[int]]] = {}
        for t, q, a, z in zip(text.tolist(), owner[i].tolist(), low.tolist(), high.tolist(), strict=True):
            held = out.setdefault((t, q), [])
            if held and a <= held[-1][1] + 1:
                held[-1][1] = max(z, held[-1][1])
            else:
                held.append([a, z])
        return out

    def runs(self, hits: list[tuple], rare: np.ndarray, ends: np.ndarray, start: np.ndarray) -> dict[tuple[int, int], list[tuple[float, int, int]]]:
        """For (text, item) the runs (cosine, first block, end) of overlapping windows that can hold the item.

        Windows of one match overlap: neighbours are one passage. It can match only if, with room for the whole
        item, it has ``least`` of the item's rare words (``rare``: item and place of each, as one number).
        """
        if not sum(len(x[0]) for x in hits):
            return {}
        text, item, first, end, cosine = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.lexsort((first, item, text))
        text, item, first, end, cosine = (x[order] for x in (text, item, first, end, cosine))
        fresh = np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1])))
        lift = np.cumsum(fresh) * len(ends)
        reach = np.maximum.accumulate(end + lift)
        fresh[1:] |= (first + lift)[1:] > reach[:-1]
        at = np.flatnonzero(fresh)
        text, item, first, end, cosine = text[at], item[at], first[at], np.maximum.reduceat(end, at), np.maximum.reduceat(cosine, at)
        more = self.room[item] - ROOM
        low, high = ends[np.maximum(first - more, start[text])], ends[np.minimum(end + more, start[text + 1])]
        held = np.searchsorted(rare, item * (ends[-1] + 1) + high) - np.searchsorted(rare, item * (ends[-1] + 1) + low)
        good = held >= self.least[item]
        out: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
        for t, q, c, b, e in zip(*(x[good].tolist() for x in (text, item, cosine, first, end)), strict=True):
            out.setdefault((t, q), []).append((c, b, e))
        return out

    def nearest(self, q: int, blocks: np.ndarray) -> float:
        """The highest cosine of an item's parts to the windows of some blocks."""
        query = self.queries[:, self.owners == q]
        x = np.concatenate([self.windows(blocks, np.array([0, len(blocks)]), scale)[1] for scale in SCALES])
        s = x @ query / (np.linalg.norm(x, axis=1) + np.float32(1e-9))[:, None]
        return float(s.max()) if s.size else 0.0

    def judge(self, texts: list[str | None]) -> list[tuple[int, int, float, int, float]]:
        """(text, item, cosine, common words, share of the answer) of every match."""
        w = Words(texts)
        at, start = cut(w.first, BLOCK)
        if not len(at):
            return []
        ends = np.append(at, len(w.slot))
        place = at + np.arange(BLOCK)[:, None]
        blocks = _taken(self.table, np.where(place < ends[1:], w.slot[np.minimum(place, len(w.slot) - 1)], SPACE))  # the last row is zero
        text_of = np.repeat(np.arange(len(texts)), np.diff(start))
        hits = []
        for scale in SCALES if len(self.owners) else ():
            own, x = self.windows(blocks, start, scale)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x)) + np.float32(1e-9)
            for i in range(0, len(own), 4096):
                s = x[i : i + 4096] @ self.queries
                hit, part = np.divmod(np.flatnonzero(s >= (self.cosine * norm[i : i + 4096])[:, None]), s.shape[1])
                block = own[i + hit]
                hits.append((text_of[block], self.owners[part], block, np.minimum(block + scale, start[text_of[block] + 1]), s[hit, part] / norm[i + hit]))
        owner, place = self.rare_places(w.hashes)
        best = self.runs(hits, owner * (len(w.slot) + 1) + place, ends, start)
        out = []
        hashes = None
        shared = self.sharing(owner, place, at, start, text_of)
        for t, q in best | shared:
            runs = best.get((t, q), [])
            words = self.words[q]
            need = self.overlap * len(words)
            found = None
            more = -(-len(words) // BLOCK)
            hashes = w.hashes.tolist() if hashes is None else hashes
            for c, b, e in sorted(runs, reverse=True):
                a, z = max(b - more, start[t]), min(e + more, start[t + 1])
                found = self.better(found, t, q, c, hashes[ends[a] : ends[z]])
            room = int(self.room[q])
            for low, high in shared.get((t, q), []):
                a, z = max(low - room, start[t]), min(high + room + 1, start[t + 1])
                if common(words, hashes[ends[a] : ends[z]], self.places[q]) < need:  # nor has any part of it
                    continue
                for b in range(low, high + 1):
                    a, z = max(b - room, start[t]), min(b + room + 1, start[t + 1])
                    found = self.better(found, t, q, None, hashes[ends[a] : ends[z]], blocks[a:z])
            if found:
                out.append(found)
        return out

    def better(self, found: tuple | None, t: int, q: int, c: float | None, passage: list, blocks: np.ndarray | None = None) -> tuple | None:
        """``found``, or the match of a passage (of cosine ``c``, or that of its ``blocks``) if it has more common words."""
        words = self.words[q]
        n = common(words, passage, self.places[q])
        if n < self.overlap * len(words) or (found is not None and n <= found[3]):
            return found
        tail = words[-max(1, len(words) // 4) :]
        share = common(tail, passage) / len(tail)
        if share < self.answer:
            return found
        return (t, q, self.nearest(q, blocks) if c is None else c, n, share)


def indexes(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id: str, item_text: str, cosine: float, overlap: float, answer: float) -> list[Index]:
    """One index for each block of items."""
    rows = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct()
    out, held = [], []
    for r in rows.orderBy("i", "t").toLocalIterator():
        held.append(r)
        if len(held) == ITEMS:
            out.append(held)
            held = []
    out += [held] if held else []
    if not out:
        return []
    words = parsed(docs.select(F.col(text_col).alias("text")), rows.select(F.col("t").alias("text")))
    weights = idf(words)
    table = fit(words, weights)
    return [Index([r["i"] for r in b], [r["t"] for r in b], table, weights, cosine, overlap, answer) for b in out]


def _judged(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, float, int, float]]:
    for i, j in slices(np.array([len(t) if t else 0 for t in texts], np.int64), CHARS):
        for t, *rest in index.judge(texts[i:j]):
            yield (t + i, *rest)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", cosine: float = 0.45, overlap: float = 0.65, answer: float = 0.5) -> DataFrame:
    """(``id_col``, item_id, cosine, common_words, item_words, answer_share) of every document that holds an item, whole or reworded."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind, item_kind = dict(rows.dtypes)[id_col], dict(items.dtypes)[item_id]
    schema = f"`{id_col}` {kind}, item_id {item_kind}, cosine double, common_words int, item_words int, answer_share double"
    parts = []
    for index in indexes(rows, items, id_col, "text", item_id, item_text, cosine, overlap, answer):
        shared = session(docs).sparkContext.broadcast(index)

        @trimmed
        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for pdf in batches:
                keys, texts = pdf[id_col].tolist(), [t if isinstance(t, str) else None for t in pdf["text"]]
                got = [(None if pd.isna(keys[t]) else keys[t], index.ids[q], c, n, len(index.words[q]), a) for t, q, c, n, a in _judged(texts, index)]
                out = pd.DataFrame(got, columns=[id_col, "item_id", "cosine", "common_words", "item_words", "answer_share"])
                yield out.assign(**{id_col: out[id_col].astype("Int64")}) if kind in ("bigint", "int") else out

        parts.append(rows.mapInPandas(run, schema))
    if not parts:
        return session(docs).createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", cosine: float = 0.45, overlap: float = 0.65, answer: float = 0.5) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    out = docs
    for index in indexes(docs, items, id_col, text_col, item_id, item_text, cosine, overlap, answer):
        shared = session(docs).sparkContext.broadcast(index)

        @trimmed
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                good = np.ones(len(texts), bool)
                good[[t for t, *_ in _judged(texts, shared.value)]] = False
                yield batch.filter(pa.array(good))

        out = out.mapInArrow(run, T.StructType(out.schema.fields))
    return out
