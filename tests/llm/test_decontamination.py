"""Decontamination: recall against brute force, and clean documents left alone."""

import random

import numpy as np

from quarrymill.llm import decontamination as D

from .fixtures import frame, rows


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_is_the_longest_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert D.common(a, b) == lcs(a, b)


def test_planted_items_are_found(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocab[:40]) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [words(rng.randint(12, 60)) for _ in range(40)]
    pairs, planted = [], set()
    for i in range(400):
        text = words(rng.randint(30, 900))
        if i % 4 == 0:
            k = rng.randrange(40)
            part = [w if rng.random() > 0.1 * (i % 3) else rng.choice(vocab) for w in items[k]]
            at = rng.randint(0, len(text))
            text[at:at] = part
            if lcs(items[k], text) >= 0.9 * len(items[k]):
                planted.add((i, k))
        pairs.append((i, " ".join(text).upper() if i % 8 == 0 else ", ".join(text)))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, ""), (0, " ".join(items[0]))], "item_id long, text string")
    docs = frame(spark, pairs + [(i + 10_000 if i is not None else None, t) for i, t in rows()])
    got = {(r["doc_id"], r["item_id"]) for r in D.matches(docs, bench).collect()}
    assert len(planted & got) >= 0.95 * len(planted)
    assert all(i is not None and i % 4 == 0 and i < 400 for i, _ in got)
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {i for i, _ in got}
    assert D.matches(frame(spark, []), bench).count() == 0 and D.matches(docs, bench.limit(0)).count() == 0
    assert D.clean(docs, bench.limit(0)).count() == docs.count() and D.clean(frame(spark, []), bench).count() == 0


def test_reworded_items_are_found_down_to_the_overlap(spark):
    rng = random.Random(12)
    vocab = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    words = lambda n: [rng.choice(vocab[:40]) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [words(rng.randint(14, 70)) for _ in range(60)]
    pairs, accepted = [], set()
    for i in range(600):
        text = words(rng.randint(60, 900))
        k = rng.randrange(60)
        # swaps of frequent and rare words, and words put in between
        part = [w if rng.random() > 0.3 else rng.choice(vocab) for w in items[k]]
        part = [x for w in part for x in ([w] if rng.random() > 0.15 else [w, *words(2)])]
        tail = items[k][-max(1, len(items[k]) // 4) :]
        if lcs(items[k], part) >= 0.65 * len(items[k]) and lcs(tail, part) >= 0.5 * len(tail):
            accepted.add((i, k))
        at = rng.randint(0, len(text))
        pairs.append((i, " ".join(text[:at] + part + text[at:])))
    assert len(accepted) > 200
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.matches(frame(spark, pairs), bench).collect()}
    assert accepted <= set(got)
    assert all(r["common_words"] >= 0.65 * r["item_words"] and -1.01 <= r["cosine"] <= 1.01 for r in got.values())


def test_the_space_is_that_of_all_documents(spark):
    rng = random.Random(21)
    vocab = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocab[: 20 + k % 280]) for _ in range(rng.randint(1, 120))) for k in range(1800)] + [None, "", " , "]
    items = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(5)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    words = D.parsed(docs, spark.createDataFrame([(t,) for t in items], "text string"))
    weights = D.idf(words)
    df = np.zeros(D.SPACE)
    rows = []
    for k, t in enumerate([*texts, *items]):
        slot = D.Words([t]).slot
        if k < len(texts):
            df[np.unique(slot)] += 1
        rows += [np.bincount(slot[i : i + 48], minlength=D.SPACE) for i in range(0, len(slot), 48)]
    assert np.allclose(weights, np.log((len(texts) + 1) / (df + 1)) + 0.01, atol=1e-5)
    used = np.flatnonzero(np.sum(rows, axis=0))
    a = np.array(rows)[:, used] * weights[used]
    a /= np.linalg.norm(a, axis=1)[:, None]
    x = np.random.default_rng(11).normal(size=(D.SPACE, 64)).astype(np.float32)
    own = D.gram_times(np.concatenate([np.repeat(np.arange(D.SPACE), r) for r in rows]), np.array([r.sum() for r in rows]), weights, x)
    assert np.allclose(own[used], a.T @ (a @ x[used]), rtol=1e-3, atol=1e-3) and not np.delete(own, used, axis=0).any()
    x = x[used]
    for _ in range(2):
        x = np.linalg.qr(a.T @ (a @ x))[0]
    value, turn = np.linalg.eigh(x.T @ (a.T @ (a @ x)))
    want = x @ turn / np.sqrt(value) * weights[used, None]
    got = D.fit(words, weights)
    assert np.allclose(got[used] @ got[used].T, want @ want.T, rtol=2e-2, atol=2e-2 * np.abs(want @ want.T).max())
    assert np.abs(np.delete(got, used, axis=0)).max() < 1e-9


class AllRuns(D.Index):
    """Every run of windows near an item is judged."""

    def runs(self, *x):
        least, self.least = self.least, np.zeros_like(self.least)
        try:
            return super().runs(*x)
        finally:
            self.least = least


def test_runs_left_out_hold_no_item():
    rng = random.Random(22)
    vocab = [f"w{k}" for k in range(400)]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (1, 13, 40, 70, 100)]
    texts = []
    for _ in range(120):
        t = [rng.choice(vocab) for _ in range(rng.randint(0, 300))]
        w = rng.choice(items).split()
        at = rng.randint(0, len(t))
        t[at:at] = [x for v in w for x in ([v] if rng.random() < 0.75 else [rng.choice(vocab), v][: rng.randint(0, 2)])]
        texts.append(" ".join(t))
    weights = np.full(D.SPACE, 1, np.float32)
    table = np.random.default_rng(3).normal(size=(D.SPACE, 64)).astype(np.float32)
    args = list(range(5)), items, table, weights, 0.3, 0.65, 0.5
    got = D.Index(*args).judge(texts)
    assert sorted(got) == sorted(AllRuns(*args).judge(texts)) and len(got) > 40
    for t, q, _, n, _ in got:
        words = items[q].split()
        assert 0.65 * len(words) <= n <= lcs(words, texts[t].split())


def test_row_sums_leave_rows_alone_that_are_done(monkeypatch):
    rng = np.random.default_rng(2)
    y = rng.integers(-9, 9, (500, 4)).astype(np.float32)
    own = np.sort(np.concatenate([np.arange(1000), np.full(4000, 17), np.full(9, 800)]))
    row = rng.integers(0, 500, len(own))
    taken, plain = [], D._taken
    monkeypatch.setattr(D, "_taken", lambda table, index: taken.append(index.size) or plain(table, index))
    slots, sums = D.row_sums(y, own, row)
    want = np.zeros((1000, 4))
    np.add.at(want, own, y[row])
    assert (slots == np.arange(1000)).all() and (sums == want).all()
    assert sum(taken) < 5000, taken  # single rows were summed with seven empty ones in every round
    assert len(D.row_sums(y, own[:0], row[:0])[0]) == 0


def test_frequencies_count_texts():
    texts = ["a b a", "", "b c", None, "b b b c", "a"]
    w = D.Words(texts)
    own = np.array([True, True, True, True, False, True])
    slot = {t: int(D.Words([t]).slot[0]) for t in "abc"}
    want = np.zeros(D.SPACE, int)
    for t, n in (("a", 2), ("b", 2), ("c", 1)):
        want[slot[t]] += n
    assert (D.frequencies(w, own) == want).all()
