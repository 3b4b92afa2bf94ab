"""Packing of documents into sequences by linear grouping.

Lengths are at most ``capacity``, so their histogram is small whatever the input, and the
whole packing is decided on the driver from it:

1. lengths over ``capacity`` / ``SMALL`` are large: sorted and cut into ``GROUPS`` groups of equal
   cardinality, each rounded up to the largest of its group, which leaves few sizes;
2. few-size configurations are optimised by column generation: a linear programme over
   patterns, each new one the best knapsack at the current prices;
3. actual pieces take the places: the longest left that a place holds, and in the last place of
   a sequence the longest that still fits, which uses what rounding up left free. Patterns go as
   often as the optimum says, rounded down, then once each until no large piece is left;
4. the small pieces go by falling length to the tightest open sequence that holds them (best
   fit), in bulk.

Ranks of pieces of one length are interchangeable, so steps 3 and 4 deal in runs of ranks, not in
pieces: their number depends on lengths and patterns alone.

The result says for each length which ranks go where; pieces get their rank within their
length in parallel (salted, so that a length with a third of all pieces is no hot key).

Null text counts as empty: its one piece is the end id. Pieces of one length are ranked by id,
piece and content within their salt; rows equal in all of these are packed each, in any order. A
text is encoded whole. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import session, staged, trimmed
from .tokens import encoder

SALTS = 64
#: Large is what exceeds this part of the capacity, and the number of groups of large lengths.
SMALL, GROUPS = 3, 128


@dataclass
class Bins:
    """``count`` sequences alike: of each (length, first rank, k) sequence j holds ranks first + j * k and the k - 1 next."""

    count: int
    free: int
    held: tuple[tuple[int, int, int], ...]

    def split(self, n: int) -> tuple[Bins, Bins]:
        rest = tuple((size, first + n * k, k) for size, first, k in self.held)
        return Bins(n, self.free, self.held), Bins(self.count - n, self.free, rest)

    def with_(self, size: int, first: int, k: int) -> Bins:
        return Bins(self.count, self.free - size * k, (*self.held, (size, first, k)))


def knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each size is used in the pattern of most worth."""
    worth, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for i, w in enumerate(sizes):
        if prices[i] > 1e-12:
            for _ in range(capacity // w):
                better = worth[:-w] + prices[i] > worth[w:] + 1e-12
                if not better.any():
                    break
                worth[w:][better] = (worth[:-w] + prices[i])[better]
                last[w:][better] = i
    used, c = np.zeros(len(sizes), int), int(worth.argmax())
    while c > 0 and last[c] >= 0:
        used[last[c]] += 1
        c -= sizes[last[c]]
    return used


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 10_000) -> list[tuple[list[int], float]]:
    """Patterns (sizes, falling) and how many sequences take each at the linear optimum."""
    n = len(sizes)
    fits = np.array([min(capacity // w, max(d, 1)) for w, d in zip(sizes, demand, strict=True)], float)
    basis, inverse, x = np.diag(fits), np.diag(1 / fits), np.array(demand, float) / fits
    for k in range(1, rounds + 1):
        prices = inverse.sum(0)
        column = knapsack(sizes, prices, capacity).astype(float)
        if prices @ column <= 1 + 1e-6:
            break
        step = (inverse * column).sum(1)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        x = np.maximum(x - ratio[out] * step, 0)
        x[out], basis[:, out] = ratio[out], column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        if k % 200 == 0:  # a Newton step against rounding errors; no threads of a linear algebra library run on the driver
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ij,jk->ik", basis, inverse))
    return [(sorted((w for w, c in zip(sizes, basis[:, i].astype(int), strict=True) for _ in range(c)), reverse=True), float(x[i])) for i in range(n) if x[i] > 1e-6]


def rounded(histogram: dict[int, int], lengths: list[int], groups: int) -> dict[int, int]:
    """How many of ``lengths`` (falling) each size stands for: the largest of each of ``groups`` groups of equal cardinality."""
    per = max(1, -(-sum(histogram[w] for w in lengths) // groups))
    out: dict[int, int] = {}
    room = size = 0
    for w in lengths:
        n = histogram[w]
        while n:
            if not room:
                size, room = w, per
            take = min(n, room)
            out[size] = out.get(size, 0) + take
            n, room = n - take, room - take
    return out


class Places:
    """Sequences filled by patterns with the pieces that are left."""

    def __init__(self, histogram: dict[int, int], lengths: list[int], capacity: int):
        self.left, self.next = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
        self.left[lengths] = [histogram[w] for w in lengths]
        self.capacity, self.bins = capacity, []

    def longest(self, room: int, used: dict[int, int]) -> int:
        """The longest piece left, beside those ``used``, of at most ``room``; 0 if there is none."""
        for w in np.flatnonzero(self.left[: room + 1])[::-1].tolist():
            if self.left[w] > used.get(w, 0):
                return w
        return 0

    def fill(self, pattern: list[int], m: int) -> None:
        """``m`` sequences by the pattern; places for which nothing is left stay free."""
        while m:
            used: dict[int, int] = {}
            free = self.capacity
            for k, size in enumerate(pattern):
                if w := self.longest(free if k == len(pattern) - 1 else min(free, size), used):
                    used[w], free = used.get(w, 0) + 1, free - w
            if not used:
                return
            n = min(m, *(int(self.left[w]) // k for w, k in used.items()))
            self.bins.append(Bins(n, free, tuple((w, int(self.next[w]), k) for w, k in used.items())))
            for w, k in used.items():
                self.next[w] += n * k
                self.left[w] -= n * k
            m -= n


def solve(histogram: dict[int, int], capacity: int, groups: int = GROUPS, small: int | None = None) -> list[Bins]:
    """Sequences for ``histogram`` (pieces by length); pieces of at most ``small`` are small."""
    small = capacity // SMALL if small is None else small
    done = [Bins(histogram[capacity], 0, ((capacity, 0, 1),))] if histogram.get(capacity) else []
    large = sorted((w for w, n in histogram.items() if small < w < capacity and n), reverse=True)
    demand = rounded(histogram, large, groups)
    patterns = sorted(configurations(list(demand), list(demand.values()), capacity), reverse=True) if demand else []
    places = Places(histogram, large, capacity)
    for pattern, x in patterns:
        places.fill(pattern, int(x + 1e-6))
    for pattern, _ in sorted(patterns, key=lambda p: -(p[1] % 1)):
        places.fill(pattern, 1)
    rest = [(w, int(places.next[w]), int(places.left[w])) for w in np.flatnonzero(places.left).tolist()]  # by rounding errors alone
    rest += [(w, 0, n) for w, n in histogram.items() if w <= small and n]
    return done + best_fit(places.bins, rest, capacity)


def best_fit(bins: list[Bins], runs: list[tuple[int, int, int]], capacity: int) -> list[Bins]:
    """Runs (length, first rank, pieces) by falling length into the tightest sequences that hold them."""
    by_free: dict[int, list[Bins]] = {}
    some = np.zeros(capacity + 1, bool)

    def put(b: Bins) -> None:
        if b.count:
            by_free.setdefault(b.free, []).append(b)
            some[b.free] = True

    for b in bins:
        put(b)
    for w, first, n in sorted(runs, key=lambda r: (-r[0], r[1])):
        while n:
            free = w + int(some[w:].argmax())
            if not some[free]:
                k = capacity // w
                m = max(1, n // k)
                put(Bins(m, capacity, ()))
                free = capacity
            b = by_free[free].pop()
            some[free] = bool(by_free[free])
            k = min(free // w, n)
            m = min(b.count, n // k)
            used, left = b.split(m)
            put(used.with_(w, first, k))
            put(left)
            first, n = first + m * k, n - m * k
    return [b for free in sorted(by_free) for b in by_free[free]]


def lookup(bins: list[Bins]) -> dict[str, np.ndarray]:
    """Segments of ranks, sorted by length and first rank."""
    rows, base = [], 0
    for b in bins:
        at = 0
        for w, first, k in b.held:
            rows.append((w, first, k, base, at))
            at += w * k
        base += b.count
    a = np.array(rows or [(0, 0, 1, 0, 0)], np.int64)
    a = a[np.lexsort((a[:, 1], a[:, 0]))]
    return {"key": a[:, 0] << 44 | a[:, 1], "first": a[:, 1], "k": a[:, 2], "sequence": a[:, 3], "offset": a[:, 4]}


def pieces(docs: DataFrame, vocabulary: str, capacity: int, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Token pieces of every document: only longer ones are cut, and only the first piece of these may be short of the capacity."""
    session(docs)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    @trimmed
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        end = np.array([end_id], "<u4")
        for pdf in batches:
            row, out = [], []
            for i, own in enumerate(enc.encode(pdf["text"].tolist())):
                ids = np.concatenate([own.astype("<u4"), end])
                at, k = 0, 0
                stop = len(ids) - (len(ids) - 1) // capacity * capacity
                while at < len(ids):
                    row.append(i)
                    out.append((k, at, stop - at, zlib.crc32(ids[at:stop])))
                    at, stop, k = stop, stop + capacity, k + 1
            df = pd.DataFrame(out, columns=["piece", "start", "length", "ids_crc32"])
            df.insert(0, id_col, pdf[id_col].iloc[row].to_numpy() if not pdf[id_col].hasnans else pdf[id_col].iloc[row].astype("Int64").to_numpy())
            yield df

    return rows.mapInPandas(cut, f"`{id_col}` {dict(rows.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", groups: int = GROUPS) -> DataFrame:
    """The pieces with sequence_id and offset."""
    salt = F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    rows = staged(pieces(docs, vocabulary, capacity, id_col, text_col)).withColumn("salt", salt)
    counts = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))  # capacity * SALTS rows at most
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = session(docs).sparkContext.broadcast(lookup(solve(histogram, capacity, groups)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy(id_col, "piece", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(inside)).join(offsets, ["length", "salt"])
    ranked = ranked.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("rank") - 1 + F.col("base")).alias("rank"))

    @trimmed
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for pdf in batches:
            w, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            i = np.searchsorted(t["key"], w << 44 | rank, side="right") - 1
            d = rank - t["first"][i]
            out = pdf.drop(columns="rank")
            yield out.assign(sequence_id=t["sequence"][i] + d // t["k"][i], offset=t["offset"][i] + d % t["k"][i] * w)

    kinds = dict(ranked.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, "piece", "start", "length", "ids_crc32"))
    return ranked.mapInPandas(place, schema + ", sequence_id long, offset long")
