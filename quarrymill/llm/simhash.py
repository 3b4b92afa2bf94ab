"""SimHash near-duplicates: fingerprints, links within a Hamming radius, and components.

Fingerprints are taken from whole texts. Equal ones are one node from there on. Nodes that
share a key meet in a task and are joined as a binary trie with itself: pairs of trie nodes
descend together, differing bits add up, and a pair whose sum exceeds the budget is dropped. A
task keeps only links that connect what its other links have not connected yet (a spanning
forest), so a group of copies never becomes all its pairs; a bucket over ``BUCKET`` nodes is
dealt out as pairs of parts. Components come from alternating star contraction, each round
written to the shared folder.

Two forms:

- ``classes``: 64-bit fingerprints of word shingles within 4 bits, exactly. Such a pair agrees in
  at least 2 of 6 blocks, so the keys are the 15 pairs of blocks.
- ``near_classes``: texts whose sets of five-word shingles have a Jaccard index of 0.8 or more,
  exactly. Every link is checked on the sets, made again from the texts. Fingerprints only make
  loose groups, wider than the links: 64-bit ones of the distinct words within ``RADIUS`` bits under
  ``TABLES`` keys, and 256-bit ones of the shingles within ``ALIKE`` bits. A group's sets meet in a
  task, which compares all of them and returns a spanning forest: neither copies nor texts that
  are a little less alike become rows by pairs. A group over ``HELD`` shingles is dealt out as pairs
  of parts, after one link a node was checked; where these connect all of it, it isn't compared.
  Links between groups come from prefixes: with all shingles in one order, sets of that similarity
  share one of their first n - 0.8 n + 1. Shingles that many texts hold come last in the order. Texts of
  different groups that meet under such a shingle are compared by parity bits of their sets, which
  bound the shingles that are in one set alone from below. What the bound lets through isn't
  returned by pairs either: a forest of it makes groups of its own, compared like the others.

Null text counts as empty: fingerprint zero, linked like any other. Rows with a null id take
part in links; a component's id is its smallest non-null id. Repeated rows keep their rows. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import BATCH_CHARS, session, slices, staged, trimmed

SEED = 42
WIDTHS = [11, 11, 11, 11, 10, 10]
#: Nodes that one task holds of a bucket.
BUCKET = 40_000
#: Pairs of trie nodes in work at once.
FRONTIER = 250_000
#: Of the near form's groups: bits that word fingerprints may differ in, keys, and bits of the shingles' fingerprints
#: (about a Jaccard index of 0.4; those of unrelated texts differ in 128). They decide the work alone, not the links found.
RADIUS, TABLES, ALIKE, NEAR_WIDTH = 12, 32, 80, 5
#: Shingles that one task holds of a group, and what a set counts beside its shingles.
HELD, ROW = 1_000_000, 50
#: Shingles in the prefixes of more rows than this come last in the order, the most frequent ``LAST`` of them.
#: Both decide the work alone, not the links found.
COMMON, LAST = 50, 1_000_000
#: Powers of two of a set's parity bits, at least and at most, and rows that a task compares by them at once.
#: They decide the work alone, not the links found.
BITS, MET = (8, 15), 20_000


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; A-Z is lower-cased first."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first = np.concatenate(([0], ends[:-1]))
    cuts = zip(first[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    return np.fromiter([digest(joined[a:b], SEED) for a, b in cuts], np.uint64, len(words) - width + 1)


def word_hashes(text: str) -> np.ndarray:
    """XXH64 of every distinct word; A-Z is lower-cased first."""
    digest = xxhash.xxh64_intdigest
    words = set(text.encode("utf-8", "surrogatepass").lower().split())
    return np.fromiter([digest(w, SEED) for w in words], np.uint64, len(words))


def spread(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th of further hashes that a hash stands for."""
    with np.errstate(over="ignore"):
        x = h + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Per list of hashes the 64-bit fingerprint: a bit is 1 if it is set in over half of them."""
    out = np.zeros(len(hashes), np.uint64)
    size = np.array([len(h) for h in hashes], np.int64)
    for i, j in slices(size, 200_000):
        n = size[i:j]
        some = np.flatnonzero(n)
        if not len(some):
            continue
        starts = np.concatenate(([0], np.cumsum(n[some])[:-1]))
        sums = np.zeros((len(some), 64), np.int64)
        flat = np.concatenate([hashes[i + k] for k in some])
        if len(some) == 1:  # one long text: in steps
            for a in range(0, len(flat), 200_000):
                sums[0] += np.unpackbits(flat[a : a + 200_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        else:
            bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[i + some] = np.packbits(2 * sums > n[some][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``id_col`` and fp (the fingerprint's bits as a long) of every row."""
    session(docs)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            parts = [majority([shingle_hashes(t, width) for t in texts[i:j]]) for i, j in slices(np.array([len(t) for t in texts], np.int64), 2 * BATCH_CHARS)]
            yield pd.DataFrame({id_col: pdf[id_col], "fp": np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)})

    return rows.mapInPandas(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, fp long")


class Forest:
    """Union-find over positions; remembers the links that connected something."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        r = self.root
        while r[i] != i:
            r[i] = r[r[i]]
            i = r[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            fresh = self.root[a] != self.root[b]
            a, b = a[fresh], b[fresh]
            for x, y in zip(a[:4096].tolist(), b[:4096].tolist(), strict=True):
                p, q = self.find(x), self.find(y)
                if p != q:
                    self.root[max(p, q)] = min(p, q)
                    self.links.append((x, y))
            a, b = a[4096:], b[4096:]
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def trie_join(keys: np.ndarray, prints: np.ndarray, budget: int, more: np.ndarray | None = None, alike: int = 0) -> list[tuple[int, int]]:
    """Links (positions) of a spanning forest of fingerprints within ``budget`` bits that share a key.

    With ``more`` (further fingerprint words per row) a link's rows may differ in ``alike`` bits of them.

    Rows are sorted by key, then fingerprint; a trie node is a range of rows, and a frontier of
    node pairs (range, range, differing bits so far, depth) descends bit by bit, small ones first.
    """
    n = len(keys)
    forest = Forest(n)
    cut = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [n]))
    lo, hi = cut[:-1], cut[1:]
    some = hi - lo > 1
    zero = np.zeros(int(some.sum()), np.int8)
    stack = [(np.stack([lo[some], hi[some], lo[some], hi[some]]), zero, 0)]
    ones: dict[int, np.ndarray] = {}
    while stack:
        node, err, depth = stack.pop()
        if node.shape[1] > FRONTIER:
            half = node.shape[1] // 2
            stack += [(node[:, :half], err[:half], depth), (node[:, half:], err[half:], depth)]
            continue
        a, b, c, d = node
        same = a == c
        pairs = np.where(same, (b - a) * (b - a - 1) // 2, (b - a) * (d - c))
        leaf = (pairs <= 8) | (depth == 64)
        if leaf.any():
            _leaves(forest, prints, a[leaf], b[leaf], c[leaf], d[leaf], budget, more, alike)
            a, b, c, d, err, same = (x[~leaf] for x in (a, b, c, d, err, same))
        if not len(a):
            continue
        if depth not in ones:
            bit = (prints >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        s = ones[depth]
        m, k = b - (s[b] - s[a]), d - (s[d] - s[c])
        other = ~same
        parts = [
            (a, m, c, k, err), (m, b, k, d, err), (a, m, k, d, err + 1),
            (m[other], b[other], c[other], k[other], err[other] + 1),
        ]
        a, b, c, d, err = (np.concatenate([p[i] for p in parts]) for i in range(5))
        good = (err <= budget) & (b > a) & (d > c) & ~((a == c) & (b - a < 2))
        if good.any():
            stack.append((np.stack([a[good], b[good], c[good], d[good]]), err[good].astype(np.int8), depth + 1))
    return forest.links


def _leaves(forest: Forest, prints: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, budget: int, more: np.ndarray | None, alike: int) -> None:
    """Compares the rows of node pairs one by one."""
    for i in range(0, len(a), FRONTIER // 8):
        x, nx, y, ny = a[i : i + FRONTIER // 8], (b - a)[i : i + FRONTIER // 8], c[i : i + FRONTIER // 8], (d - c)[i : i + FRONTIER // 8]
        size = nx * ny
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        u = np.repeat(x, size) + at // np.repeat(ny, size)
        v = np.repeat(y, size) + at % np.repeat(ny, size)
        near = (u < v) & (np.bitwise_count(prints[u] ^ prints[v]) <= budget)
        u, v = u[near], v[near]
        if more is not None and len(u):
            apart = forest.root[u] != forest.root[v]
            u, v = u[apart], v[apart]
            near = np.bitwise_count(more[u] ^ more[v]).sum(axis=1, dtype=np.int64) <= alike
            u, v = u[near], v[near]
        forest.add(u, v)


def dealt(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` of rows that have a key, sorted by key in partitions; full buckets as pairs of parts.

    Rows of one part of a full bucket meet in each pair that the part is in.
    """
    full = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > BUCKET))
    parts = F.coalesce(F.ceil(F.col("held") / F.lit(BUCKET // 2)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(cols[0]), F.col("parts")).cast("int")
    out = rows.join(full, "key", "left").withColumn("parts", parts).withColumn("own", own)
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    out = out.select(*cols, F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"))
    return out.repartition("key").sortWithinPartitions("key")


def keyed(nodes: DataFrame, keys: list[Column], cols: list[str]) -> DataFrame:
    """``cols`` of each node under each of its keys (column key)."""
    return nodes.select(*cols, F.explode(F.array(*keys)).alias("key"))


def linked(rows: DataFrame, cols: list[str], budget: int, alike: int = 0) -> DataFrame:
    """(u, v): links of ``dealt`` rows. ``cols``: node, fingerprint, and words of the longer fingerprint if there is one."""

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((0, len(cols) + 1), np.int64)
        for pdf in batches:
            held = np.concatenate([held, pdf[["key", *cols]].to_numpy(np.int64)])
            last = int(np.searchsorted(held[:, 0], held[-1, 0])) if len(held) else 0  # the last key may go on
            if last >= 100_000:
                yield joined(held[:last])
                held = held[last:]
        yield joined(held)

    def joined(rows: np.ndarray) -> pd.DataFrame:
        prints = rows[:, 2].view(np.uint64)
        order = np.lexsort((prints, rows[:, 0]))
        rows, prints = rows[order], prints[order]
        more = np.ascontiguousarray(rows[:, 3:]).view(np.uint64) if len(cols) > 2 else None
        got = np.array(trie_join(rows[:, 0], prints, budget, more, alike), np.int64).reshape(-1, 2)
        u, v = rows[got[:, 0], 1], rows[got[:, 1], 1]
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()

    return rows.select("key", *cols).mapInPandas(run, "u long, v long").where("u <> v")


def links(nodes: DataFrame, budget: int = 4) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that connect all that are within ``budget`` bits."""
    if budget > len(WIDTHS) - 2:
        raise ValueError("the blocks cover up to 4 differing bits")
    at = [sum(WIDTHS[:k]) for k in range(len(WIDTHS))]
    block = lambda k: F.shiftrightunsigned("fp", at[k]).bitwiseAND(F.lit((1 << WIDTHS[k]) - 1))
    keys = [F.lit(n << 22).cast("long") + block(i) * F.lit(1 << 11) + block(j) for n, (i, j) in enumerate(combinations(range(len(WIDTHS)), 2))]
    nodes = nodes.select(F.col("fp").alias("node"), "fp")
    return linked(dealt(keyed(nodes, keys, ["node", "fp"]), ["node", "fp"]), ["node", "fp"], budget)


def near_links(nodes: DataFrame, tables: int = TABLES, radius: int = RADIUS, alike: int = ALIKE) -> DataFrame:
    """(u, v): links between nodes (columns node, fp, s0 to s3) whose word fingerprints meet under a key and whose shingles are alike."""
    rng = np.random.default_rng(3)
    blocks = [sorted(rng.choice(16, 5, replace=False).tolist()) for _ in range(tables)]
    nibble = lambda k: F.shiftrightunsigned("fp", 4 * k).bitwiseAND(F.lit(15))
    keys = [sum((nibble(k) * F.lit(1 << 4 * i) for i, k in enumerate(b)), F.lit(n << 20).cast("long")) for n, b in enumerate(blocks)]
    cols = ["node", "fp", "s0", "s1", "s2", "s3"]
    return linked(dealt(keyed(nodes, keys, cols), cols), cols, radius, alike)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (u, v); root is the smallest node of its component.

    Large-star and small-star rounds until the edges are all (root, node) stars.
    """
    now = staged(edges.distinct())
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = staged(large)
        least = staged(large.groupBy("v").agg(F.min("u").alias("m")))
        small = large.join(least, "v").select(F.col("m"), F.explode(F.array("u", "v")).alias("v")).where("m <> v").select(F.col("m").alias("u"), "v")
        now = staged(small.distinct())
        mine = mark(now)
        if mine == seen:
            break
        seen = mine
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _labels(prints: DataFrame, nodes: DataFrame, edges: DataFrame, id_col: str) -> DataFrame:
    """``prints`` (``id_col``, node) with the component_id of each; ``nodes``: node and low, its smallest id."""
    found = components(edges)
    known = staged(found.withColumnRenamed("node", "__n").join(nodes, F.col("__n") == F.col("node")).select("node", "root", "low"))
    lows = staged(known.groupBy("root").agg(F.min("low").alias("component_id")))
    table = staged(known.join(lows, "root").select("node", "component_id"))
    table = staged(nodes.join(table, "node", "left").select("node", F.coalesce("component_id", "low").alias("component_id")))
    return prints.join(table, "node").select(id_col, "node", "component_id")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4) -> DataFrame:
    """``id_col``, fp and component_id of every row."""
    prints = staged(fingerprints(docs, id_col, text_col, width).withColumnRenamed("fp", "node"))
    nodes = staged(prints.groupBy("node").agg(F.min(id_col).alias("low")))
    return _labels(prints, nodes, links(nodes.withColumnRenamed("node", "fp"), budget), id_col).withColumnRenamed("node", "fp")


def in_order(shingles: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set that all sets alike share one of; those of ``last`` (sorted) end the order."""
    n = len(shingles)
    if len(last) and n:
        shingles = shingles[np.argsort(last[np.minimum(np.searchsorted(last, shingles), len(last) - 1)] == shingles, kind="stable")]
    return shingles[: n - (4 * n + 4) // 5 + 1 if n else 0]


def parity(shingles: np.ndarray) -> np.ndarray:
    """A set's bits, in words, about one a shingle: a bit is 1 if an odd number of shingles falls on it.

    Two sets' bits differ in no more places than shingles are in one of the sets alone; so do both
    halves of the bits laid over each other by XOR, the bits of half the length.
    """
    bits = 1 << min(max((len(shingles) - 1).bit_length(), BITS[0]), BITS[1])
    held = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((held & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def common_shingles(docs: DataFrame, text_col: str = "text", width: int = NEAR_WIDTH) -> np.ndarray:
    """Shingles in the prefixes (by hash alone) of more than ``COMMON`` rows, sorted; the ``LAST`` most frequent of them."""
    session(docs)
    none = np.zeros(0, np.uint64)

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [in_order(np.unique(shingle_hashes(t, width)), none) for t in pdf["text"] if isinstance(t, str)]
            token, n = np.unique(np.concatenate([none, *got]), return_counts=True)
            yield pd.DataFrame({"token": token.view(np.int64), "n": n})

    count = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("c"))
    often = count.where(F.col("c") > COMMON).orderBy(F.desc("c"), "token").limit(LAST).select("token").toPandas()["token"]
    return np.sort(often.to_numpy(np.int64).view(np.uint64))


def near_fingerprints(docs: DataFrame, last: np.ndarray, id_col: str = "doc_id", text_col: str = "text", width: int = NEAR_WIDTH) -> DataFrame:
    """``id_col``, h (hash of the text), node (of the set of its shingles), fp of the distinct words, s0 to s3, the 256 bits of the shingles, n of the set, its prefix and its parity bits."""
    shared = session(docs).sparkContext.broadcast(last)
    rows = docs.select(F.col(id_col), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    words = ["fp", "s0", "s1", "s2", "s3"]

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = shared.value
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            out = np.zeros((len(texts), 5), np.uint64)
            sets: list[tuple[int, int, bytes, bytes]] = []
            for i, j in slices(np.array([len(t) for t in texts], np.int64), 2 * BATCH_CHARS):
                out[i:j, 0] = majority([word_hashes(t) for t in texts[i:j]])
                h = [shingle_hashes(t, width) for t in texts[i:j]]
                for k in range(4):
                    out[i:j, k + 1] = majority([spread(x, k) for x in h])
                for x in map(np.unique, h):
                    sets.append((xxhash.xxh64_intdigest(x.tobytes(), SEED) - (1 << 63), len(x), in_order(x, last).tobytes(), parity(x).tobytes()))
            found = pd.DataFrame(out.view(np.int64), columns=words).assign(h=pdf["h"].to_numpy(), **{id_col: pdf[id_col].to_numpy()})
            found["node"], found["n"] = np.array([x[0] for x in sets], np.int64), np.array([x[1] for x in sets], np.int32)
            found["prefix"], found["bits"] = [x[2] for x in sets], [x[3] for x in sets]
            yield found[[id_col, "h", "node", *words, "n", "prefix", "bits"]]

    return rows.mapInPandas(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, h long, node long, fp long, s0 long, s1 long, s2 long, s3 long, n int, prefix binary, bits binary")


def tokens(nodes: DataFrame) -> DataFrame:
    """(node, comp, n, pos, key): each shingle of the prefixes of ``nodes`` (node, comp, n, prefix) as a key."""

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = [np.frombuffer(x, np.int64) for x in pdf["prefix"]]
            size = np.array([len(x) for x in held], np.int64)
            pos = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            many = {c: np.repeat(pdf[c].to_numpy(), size) for c in ("node", "comp", "n")}
            yield pd.DataFrame({**many, "pos": pos.astype(np.int32), "key": np.concatenate([np.zeros(0, np.int64), *held])})

    return nodes.select("node", "comp", "n", "prefix").mapInPandas(run, "node long, comp long, n int, pos int, key long")


def _partners(key: np.ndarray, comp: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of rows (sorted by key, then n) of one key and two components whose sizes allow the similarity, in steps."""
    bucket = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))[: len(key)]
    end = np.searchsorted((bucket << 36) + n, (bucket << 36) + 5 * n // 4, side="right")
    size = end - np.arange(len(key)) - 1
    for i, j in slices(size, 1_000_000):
        for a in range(0, int(size[i:j].max(initial=0)), 1_000_000):  # one row with many others: in steps
            m = np.clip(size[i:j] - a, 0, 1_000_000)
            u = np.repeat(np.arange(i, j), m)
            v = u + 1 + a + np.arange(len(u)) - np.repeat(np.cumsum(m) - m, m)
            apart = comp[u] != comp[v]
            yield u[apart], v[apart]


def _meeting(rows: np.ndarray) -> pd.DataFrame:
    """(key, node) of rows (key, node, comp, n, pos) that have a partner: a row of their key, of another component, that can have the similarity.

    Keys under which the same nodes have partners become one, made of these nodes.
    """
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 0]))]
    # shingles that one component alone holds go first: its nodes need not be compared
    key, comp = rows[:, 0], rows[:, 2]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(rows)])
    end = np.append(begin[1:], len(rows))
    rows = rows[np.repeat(comp[begin] != comp[end - 1], end - begin)] if len(rows) else rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 0]))]
    key, node, comp, n, pos = rows.T
    met = np.zeros(len(rows), bool)
    for u, v in _partners(key, comp, n):
        # of the shared shingles no more than these stand before, at and after this one
        most = np.minimum(pos[u], pos[v]) + np.minimum(n[u] - pos[u], n[v] - pos[v])
        good = 9 * most >= 4 * (n[u] + n[v])
        met[u[good]] = met[v[good]] = True
    key, node = key[met], node[met]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    if len(begin):
        with np.errstate(over="ignore"):
            nodes = np.add.reduceat(spread(node.view(np.uint64), 1), begin)
        key = np.repeat(nodes, np.diff(np.append(begin, len(key)))).view(np.int64)
    return pd.DataFrame({"key": key, "node": node}).drop_duplicates()


def bit_links(rows: pd.DataFrame) -> pd.DataFrame:
    """(u, v): links that connect all pairs of nodes of rows (key, node, comp, n, bits) of one key and two components whose bits allow the similarity."""
    rows = rows.sort_values(["key", "n"])
    key, comp, n = (rows[c].to_numpy(np.int64) for c in ("key", "comp", "n"))
    name, first, node = np.unique(rows["node"].to_numpy(np.int64), return_index=True, return_inverse=True)
    forest = Forest(len(name))
    bits = rows["bits"].to_numpy()[first]
    width = np.array([len(x) // 8 for x in bits], np.int64)
    words = lambda at, w: np.frombuffer(b"".join(bits[at]), np.uint64).reshape(-1, w)
    tables = {}
    for w in np.unique(width).tolist():  # of two sets that can be alike the larger has as many bits or twice as many
        own, twice = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        place = np.zeros(len(name), np.int64)
        place[own], place[twice] = np.arange(len(own)), len(own) + np.arange(len(twice))
        more = words(twice, 2 * w)
        tables[w] = place, np.concatenate([words(own, w), more[:, :w] ^ more[:, w:]])
    for i, j in _partners(key, comp, n):
        a, b, most = node[i], node[j], (n[i] + n[j]) // 9
        for w, (place, table) in tables.items():
            at = np.flatnonzero(width[a] == w)
            for k in range(0, len(at), FRONTIER // 4):  # some of the bits first
                u, v, m = (x[at[k : k + FRONTIER // 4]] for x in (a, b, most))
                near = (forest.root[u] != forest.root[v]) & (np.bitwise_count(table[place[u], :4] ^ table[place[v], :4]).sum(axis=1, dtype=np.int64) <= m)
                u, v, m = u[near], v[near], m[near]
                for lo in range(0, len(u), 1 + (1 << 20) // w):
                    x, y, z = (c[lo : lo + 1 + (1 << 20) // w] for c in (u, v, m))
                    near = np.bitwise_count(table[place[x]] ^ table[place[y]]).sum(axis=1, dtype=np.int64) <= z
                    forest.add(x[near], y[near])
    got = np.array(forest.links, np.int64).reshape(-1, 2)
    u, v = name[got[:, 0]], name[got[:, 1]]
    return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})


def prefix_pairs(nodes: DataFrame) -> DataFrame:
    """(u, v): links that connect all pairs of ``nodes`` (node, comp, n, prefix, bits) of different components whose sets can have the similarity.

    Neither step makes rows by pairs: the first keeps rows of the prefixes, the second returns a forest a task.
    """
    cols = ["node", "comp", "n", "pos"]

    @trimmed
    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((0, 5), np.int64)
        for pdf in batches:
            held = np.concatenate([held, pdf.to_numpy(np.int64)])
            last = int(np.searchsorted(held[:, 0], held[-1, 0])) if len(held) else 0  # the last key may go on
            if last >= 100_000:
                yield _meeting(held[:last])
                held = held[last:]
        yield _meeting(held)

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= MET:
                rows = pd.concat(held)
                last = int(np.searchsorted(rows["key"].to_numpy(), rows["key"].iloc[-1]))  # the last key may go on
                if last >= MET:
                    yield bit_links(rows[:last])
                held = [rows[last:] if last >= MET else rows]
        if held:
            yield bit_links(pd.concat(held))

    met = staged(dealt(tokens(nodes), cols).select("key", *cols).mapInPandas(meet, "key long, node long").distinct())
    rows = met.join(nodes.select("node", "comp", "n", "bits").hint("shuffle_merge"), "node").select("key", "node", "comp", "n", "bits")
    return staged(rows.repartition("key").sortWithinPartitions("key").mapInPandas(run, "u long, v long"))


def texts_of(docs: DataFrame, nodes: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, text) for each h of ``nodes``: a text with that hash, once."""
    low = lambda c: F.col(c).bitwiseAND(F.lit((1 << 18) - 1))
    some = nodes.select(low("h").alias("low")).distinct()  # 2 ** 18 rows at most
    texts = docs.select(F.xxhash64(text_col).alias("h"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = texts.withColumn("low", low("h")).join(F.broadcast(some), "low", "left_semi").drop("low")
    return texts.join(nodes.select("h").distinct().hint("shuffle_merge"), "h", "left_semi").dropDuplicates(["h"])


def shingle_sets(docs: DataFrame, nodes: DataFrame, text_col: str = "text", width: int = NEAR_WIDTH) -> DataFrame:
    """(node, shingles) of ``nodes`` (node, h): the sorted hashes of the distinct shingles of a text with the hash h."""

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "shingles": [np.unique(shingle_hashes(t, width)).tobytes() for t in pdf["text"]]})

    texts = texts_of(docs, nodes, text_col).join(nodes.select("node", "h"), "h")
    return texts.select("node", "text").mapInPandas(run, "node long, shingles binary")


def set_links(comp: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (positions) that connect all sets with a Jaccard index of 0.8 or more; those of one ``comp`` are connected.

    Shared shingles are counted for some rows against all at a time: those that many sets hold by a
    product of matrices, others by the lists of the sets that hold them.
    """
    k, n = len(sets), np.array([len(x) for x in sets], np.int64)
    forest = Forest(k)
    _, first, own = np.unique(comp, return_index=True, return_inverse=True)
    if len(first) < 2:
        return forest.links
    forest.root = first[own]
    row = np.repeat(np.arange(k), n)
    _, token, df = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    often, some = df[token] > max(32, k // 16), df[token] > 1
    often_row, (often_token, col) = row[often], np.unique(token[often], return_inverse=True)
    some &= ~often
    row, token = row[some], token[some]
    held = row[np.argsort(token, kind="stable")]
    size = np.bincount(token, minlength=len(df))
    start = np.cumsum(size) - size
    step = max(1, (1 << 20) // k)
    for a in range(0, k, step):
        b = min(a + step, k)
        shared = np.zeros((b - a, k), np.float32)
        for lo in range(0, len(often_token), 1024):
            at = (col >= lo) & (col < lo + 1024)
            x = np.zeros((k, 1024), np.float32)
            x[often_row[at], col[at] - lo] = 1
            shared += x[a:b] @ x.T
        count = shared.astype(np.int64).ravel()
        i, j = np.searchsorted(row, [a, b])
        many = size[token[i:j]]
        for p, q in slices(many, 1_000_000):
            m = many[p:q]
            place = np.repeat(start[token[i + p : i + q]] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
            count += np.bincount(np.repeat(row[i + p : i + q] - a, m) * k + held[place], minlength=len(count))
        u, v = np.nonzero(9 * count.reshape(b - a, k) >= 4 * (n[a:b, None] + n))
        later = v > u + a
        forest.add(u[later] + a, v[later])
    return forest.links


def group_links(nodes: DataFrame, docs: DataFrame, text_col: str = "text", width: int = NEAR_WIDTH) -> DataFrame:
    """(u, v): links that connect all pairs alike inside each group of ``nodes`` (node, h, n, comp, grp); nodes of one comp are connected."""
    weight = F.sum(F.col("n") + F.lit(ROW))
    groups = nodes.groupBy("grp").agg(weight.alias("held"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b")
    parts = F.when(F.col("held") > HELD, F.ceil(F.col("held") / F.lit(HELD // 2))).otherwise(F.lit(1)).cast("int")
    rows = staged(nodes.join(groups.select("grp", parts.alias("parts")), "grp").select("node", "h", "comp", "grp", "parts", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("own")))
    texts = texts_of(docs, rows, text_col).join(rows, "h")
    texts = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    texts = texts.select(F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "node", "comp", "text")

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy(np.int64)
        got = np.array(set_links(rows["comp"].to_numpy(np.int64), [np.unique(shingle_hashes(t, width)) for t in rows["text"]]), np.int64).reshape(-1, 2)
        u, v = node[got[:, 0]], node[got[:, 1]]
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            key = pdf["key"].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(pdf)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # the last key may go on
                if held and len(pdf) and key[a] != held[0]["key"].iloc[0]:
                    yield joined(pd.concat(held))
                    held = []
                if b > a:
                    held.append(pdf.iloc[a:b])
        if held:
            yield joined(pd.concat(held))

    return staged(texts.repartition("key").sortWithinPartitions("key").mapInPandas(run, "u long, v long"))


def alike_pairs(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str = "text") -> DataFrame:
    """Those of the pairs (u, v) whose sets have a Jaccard index of 0.8 or more."""
    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    some = staged(nodes.select("node", "h").join(ends, "node", "left_semi"))
    sets = staged(shingle_sets(docs, some, text_col))
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")

    @trimmed
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = []
            for a, b in zip(pdf["a"], pdf["b"], strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(9 * both >= 4 * (len(x) + len(y)))
            yield pdf.loc[np.array(good, bool), ["u", "v"]]

    return staged(both.select("u", "v", "a", "b").mapInPandas(run, "u long, v long"))


def grouped(nodes: DataFrame, loose: DataFrame) -> DataFrame:
    """``nodes`` with grp, their component by the links ``loose`` (u, v)."""
    found = components(loose).withColumnRenamed("node", "__n")
    return staged(nodes.join(found, F.col("__n") == F.col("node"), "left").select(*nodes.columns, F.coalesce("root", "node").alias("grp")))


def alike_inside(now: DataFrame, loose: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(u, v): links that connect all pairs alike inside each group of ``now`` (node, h, n, grp), made by the links ``loose``."""
    # of groups that no task holds one link a node is checked first: much of them is connected from then on
    large = staged(now.groupBy("grp").agg(F.sum(F.col("n") + F.lit(ROW)).alias("held")).where(F.col("held") > HELD).select("grp"))
    one = loose.join(now.join(large, "grp", "left_semi").select(F.col("node").alias("v")), "v", "left_semi")
    first = alike_pairs(staged(one.groupBy("v").agg(F.max("u").alias("u")).select("u", "v")), docs, now, text_col)
    known = components(first).withColumnRenamed("node", "__n")
    members = now.join(known, F.col("__n") == F.col("node"), "left").select("node", "h", "n", F.coalesce("root", "node").alias("comp"), "grp")
    return first.unionByName(group_links(members, docs, text_col))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, node (equal for equal sets of shingles) and component_id of every row."""
    prints = staged(near_fingerprints(docs, common_shingles(docs, text_col), id_col, text_col))
    rows = prints.select(id_col, "node")
    rest = [F.first(c).alias(c) for c in ("fp", "s0", "s1", "s2", "s3", "n", "prefix", "bits")]  # equal for equal sets
    nodes = staged(prints.groupBy("node").agg(F.min(id_col).alias("low"), F.min("h").alias("h"), *rest))
    near = staged(near_links(nodes))
    now = grouped(nodes.select("node", "h", "n", "prefix", "bits"), near)
    inner = alike_inside(now, near, docs, text_col)
    met = prefix_pairs(now.withColumnRenamed("grp", "comp"))
    more = alike_inside(grouped(nodes.select("node", "h", "n"), met), met, docs, text_col)
    return _labels(rows, nodes.select("node", "low"), inner.unionByName(more), id_col)


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies (``near_classes``): the one with the smallest id.

    Of rows that share an id, those that the group keeps are one per text; rows without an id are
    kept unless an equal text or a near copy has one.
    """
    found = staged(near_classes(docs, id_col, text_col))
    ids = staged(found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__id")).distinct())
    again = staged(found.groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("__again")))
    # as large as the documents at any size that matters: the same plan at all sizes, so that small runs tell of large ones
    kept = docs.join(ids.hint("shuffle_merge"), F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    once = kept.join(again, F.col(id_col).eqNullSafe(F.col("__again")), "left_anti")
    twice = kept.join(again, F.col(id_col).eqNullSafe(F.col("__again")), "left_semi").withColumn("__p", F.xxhash64(text_col))
    return once.unionByName(twice.dropDuplicates([id_col, "__p"]).drop("__p"))
