"""Fingerprints, links and components against brute force."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash

from quarrymill.llm import simhash as S

from .fixtures import frame, rows


def by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, budget=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_components_match_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(400))
    pairs = rows() + [(6000 + i, base.replace(f"w{i * 7} ", f"z{i} ")) for i in range(30)]
    got = S.classes(frame(spark, pairs)).collect()
    prints = [by_hand(t) for _, t in pairs]
    comp = groups(prints)
    low = {}
    for (i, _), c in zip(pairs, comp, strict=True):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    want = Counter((i, p, low.get(c)) for (i, _), p, c in zip(pairs, prints, comp, strict=True))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    assert S.classes(frame(spark, [])).count() == 0


def test_near_copies(spark):
    base = " ".join(f"w{i}" for i in range(400))
    pairs = rows() + [(6000 + i, base.replace(f"w{i * 7} ", f"z{i} ")) for i in range(30)] + [(6100, " ".join(f"w{i}" for i in range(200)) + " v" * 200)]
    df = frame(spark, pairs)
    comp = jaccard_groups([words_of(t) for _, t in pairs])
    low = {}
    for (i, _), c in zip(pairs, comp, strict=True):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    want = Counter((i, low.get(c)) for (i, _), c in zip(pairs, comp, strict=True))
    assert Counter((r["doc_id"], r["component_id"]) for r in S.near_classes(df).collect()) == want
    assert want[(6029, 6000)] and want[(6100, 6100)]
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(low.values())
    assert S.keep_one(frame(spark, [])).count() == 0


def test_trie_join_finds_every_component():
    rng = np.random.default_rng(5)
    for size, spread in ((60, 3), (300, 6), (800, 2)):
        centre = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
        prints = centre[rng.integers(0, 12, size)]
        for _ in range(spread):
            prints = prints ^ (np.uint64(1) << rng.integers(0, 64, size, dtype=np.uint64))
        prints = np.unique(prints)
        n = len(prints)
        links = S.trie_join(np.zeros(n, np.int64), prints, 4)
        assert len(links) < n and all((int(prints[a]) ^ int(prints[b])).bit_count() <= 4 for a, b in links)
        comp = groups([int(p) for p in prints])
        root = list(range(n))

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in links:
            root[find(a)] = find(b)
        assert len({find(i) for i in range(n)}) == len(set(comp))


def test_full_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 8)
    rng = np.random.default_rng(6)
    prints = np.unique(np.uint64(0xABCDEF0123456789) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)))
    nodes = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    found = S.components(S.links(nodes)).collect()
    assert len({r["root"] for r in found}) == len(set(groups([int(p) for p in prints]))) == 1 and len(found) == len(prints)


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def jaccard_groups(texts, least=0.8):
    """Groups of word lists by the Jaccard index of their five-word shingles."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def components_of(spark, texts):
    got = {r["doc_id"]: r["component_id"] for r in S.near_classes(frame(spark, list(enumerate(texts)))).collect()}
    groups = jaccard_groups([words_of(t) for t in texts])
    low = {g: min(i for i, x in enumerate(groups) if x == g) for g in groups}
    return got, {i: low[g] for i, g in enumerate(groups)}


def test_extended_and_shortened_copies_are_found(spark, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda n: [f"v{x}" for x in rng.integers(0, 1 << 40, n)]
    licence = word(12)
    texts = []
    for _ in range(40):
        base = word(int(rng.integers(40, 400))) + licence
        n = len(base)
        texts += [base, base + word(int(0.21 * n)), word(int(0.1 * n)) + base, base[: int(0.84 * n)], base[: int(0.7 * n)]]
    monkeypatch.setattr(S, "COMMON", 20)
    got, want = components_of(spark, [" ".join(t) for t in texts])
    assert got == want


def test_no_link_below_the_similarity(spark):
    rng = np.random.default_rng(10)
    texts = []
    for _ in range(30):
        base = [f"v{x}" for x in rng.integers(0, 1 << 40, 300)]
        for changes in (9, 14, 20):
            copy = list(base)
            for k in rng.choice(300, changes, replace=False):
                copy[k] = f"z{rng.integers(0, 1 << 40)}"
            texts.append(copy)
        texts.append(base)
    got, want = components_of(spark, [" ".join(t) for t in texts])
    assert got == want


def loose_group(rng, copies, words=120, changes=8):
    """Copies of one text of which few are alike: most pairs have a Jaccard index of some 0.5 to 0.7."""
    base = [f"v{x}" for x in rng.integers(0, 1 << 40, words)]
    out = []
    for _ in range(copies):
        copy = list(base)
        for k in rng.choice(words, int(rng.integers(1, changes)), replace=False):
            copy[k] = f"z{rng.integers(0, 1 << 40)}"
        out.append(" ".join(copy))
    return out


def test_a_loose_group_makes_no_rows_by_pairs(spark, monkeypatch):
    rng = np.random.default_rng(14)
    texts = loose_group(rng, 150) + loose_group(rng, 40, changes=20)
    made = []
    pairs = S.prefix_pairs
    monkeypatch.setattr(S, "prefix_pairs", lambda nodes: made.append(pairs(nodes)) or made[-1])
    got, want = components_of(spark, texts)
    assert got == want and 1 < len(set(want.values())) < len(texts)
    assert made[0].count() <= len(texts)


def test_groups_over_a_tasks_share_are_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(15)
    texts = [t for k in range(3) for t in loose_group(rng, 60, changes=6 + 6 * k)]
    monkeypatch.setattr(S, "HELD", 1500)
    got, want = components_of(spark, texts)
    assert got == want and 3 < len(set(want.values())) < len(texts)


def test_set_links_match_brute_force(monkeypatch):
    rng = np.random.default_rng(16)
    for k in (1, 7, 90, 400):
        sets = [np.unique(rng.integers(0, 40, rng.integers(0, 40)).astype(np.uint64)) for _ in range(k)]
        comp = np.arange(k) if k < 90 else np.where(np.arange(k) < 5, 0, np.arange(k))
        alike = lambda a, b: 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))
        assert all(alike(sets[a], sets[b]) for a, b in S.set_links(comp, sets))
        joined = S.Forest(k)
        for a, b in [*S.set_links(comp, sets), *((0, i) for i in range(k) if comp[i] == 0)]:
            joined.add(np.array([a]), np.array([b]))
        wanted = S.Forest(k)
        for a in range(k):
            for b in range(a):
                if comp[a] == comp[b] or alike(sets[a], sets[b]):
                    wanted.add(np.array([b]), np.array([a]))
        assert [joined.find(i) for i in range(k)] == [wanted.find(i) for i in range(k)]


def test_texts_that_meet_between_groups_make_no_rows_by_pairs(spark, monkeypatch):
    rng = np.random.default_rng(17)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 1 << 40, 25))
    texts = loose_group(rng, 200, words=300, changes=4) + loose_group(rng, 60, changes=14)
    texts += [" ".join(f"v{x}" for x in rng.integers(0, 1 << 40, 70)) + " " + passage for _ in range(150)]
    made = []
    pairs = S.prefix_pairs
    # no group comes from fingerprints: all links are between groups
    monkeypatch.setattr(S, "near_links", lambda nodes: spark.createDataFrame([], "u long, v long"))
    monkeypatch.setattr(S, "prefix_pairs", lambda nodes: made.append(pairs(nodes)) or made[-1])
    got, want = components_of(spark, texts)
    assert got == want and 100 < len(set(want.values())) < len(texts) - 200
    assert made[0].count() < 10 * len(texts)


def test_rows_that_meet_keep_their_number():
    rng = np.random.default_rng(18)
    key = np.repeat([3, 5, 8, 9], [300, 300, 40, 1])
    node = np.concatenate([np.arange(300), np.arange(300), rng.choice(300, 41)])
    n = 20 + node * 2
    rows = np.stack([key, node, node % 90, n, rng.integers(0, 4, len(key))], 1)
    met = S._meeting(rows)
    assert len(met) <= len(rows)
    together = [set(x) for _, x in met.groupby("key")["node"]]
    for k in (3, 5, 8):
        at = rows[rows[:, 0] == k]
        for a in at[::7]:
            for b in at[a[3] <= at[:, 3]]:
                most = min(a[4], b[4]) + min(a[3] - a[4], b[3] - b[4])
                assert a[2] == b[2] or 9 * most < 4 * (a[3] + b[3]) or any({a[1], b[1]} <= t for t in together)


def test_parity_bits_lose_no_pair(monkeypatch):
    rng = np.random.default_rng(19)
    monkeypatch.setattr(S, "BITS", (8, 11))
    sets = []
    for size in (1, 5, 60, 230, 256, 300, 520, 900, 1800, 2500, 5000):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for _ in range(8):
            copy = base[rng.random(size) > rng.choice([0, 0.05, 0.12, 0.2])]
            sets.append(np.unique(np.concatenate([copy, rng.integers(0, 1 << 63, int(size * rng.choice([0, 0.05, 0.12, 0.2])), dtype=np.uint64)])))
    k = len(sets)
    rows = pd.DataFrame({"key": 1, "node": np.arange(k) * 7, "comp": np.arange(k), "n": [len(x) for x in sets], "bits": [S.parity(x).tobytes() for x in sets]})
    found = S.bit_links(pd.concat([rows, rows.assign(key=2)]).query("n > 0"))
    assert len(found) < k
    joined = S.Forest(k)
    joined.add(found["u"].to_numpy() // 7, found["v"].to_numpy() // 7)
    alike = [(a, b) for a in range(k) for b in range(a) if len(sets[a]) and 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))]
    assert len(alike) > 80 and all(joined.find(a) == joined.find(b) for a, b in alike)
    bits = [S.parity(x) for x in sets]
    for a, b in [(a, b) for a in range(k) for b in range(a) if len(bits[a]) == len(bits[b])]:
        assert np.bitwise_count(bits[a] ^ bits[b]).sum() <= len(np.setxor1d(sets[a], sets[b]))
