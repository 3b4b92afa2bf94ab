"""Models: exact base scores, sound probabilities and held-out quality."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import language_id as L
from quarrymill.llm import lm_mixing as M
from quarrymill.llm import quality_classifier as Q
from quarrymill.llm._common import remainder

from .fixtures import frame, rows


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def crc(i, n):
    return zlib.crc32(str("" if i is None else i).encode()) % n


def test_base_score_is_exact(spark, monkeypatch):
    monkeypatch.setattr(M, "FREQUENT", 50)
    monkeypatch.setattr(M, "CHARS", 3000)
    pairs = rows()
    got = M.score(frame(spark, pairs), remainder("doc_id", 7) != 2).collect()
    c = Counter(w for i, t in pairs if crc(i, 7) != 2 for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in pairs:
        w = tokens(t)
        want[(i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["bits_per_byte"] < 6
    assert M.score(frame(spark, []), F.lit(True)).count() == 0
    # without training: a bit each for white space of one space (else 4), for end or escape, and for the bits of spelled bytes
    for r in M.score(frame(spark, pairs), F.lit(False)).collect():
        text = next(t for i, t in pairs if i == r["doc_id"]) if r["doc_id"] not in {pairs[5][0], None} else None
        if text is not None:
            want = sum(1 + (1 if gap == " " else 4 if gap in GAPS else 4 + (len(gap) + 1) * math.log2(7)) + (8 * len(word.encode()) + 8 if word else 0) for gap, word in units(text))
            assert abs(r["score"] + want * math.log10(2)) < 1e-3 * (1 + want)


GAPS = {" ": 0, "\n": 1, "": 2, "\n\n": 3, "  ": 4, "\t": 5, "\r\n": 6}


def units(text):
    """(white space, word) of a text, the end's word is empty."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out = re.findall(r"([\x20\x09-\x0D]*)([^\x20\x09-\x0D]+)", low)
    return [*out, (low[len("".join(g + w for g, w in out)) :], "")]


def trained(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = M.word_counts(df)
    counts = Counter(w for t in texts for w in tokens(t))
    return M.train(df, words, sum(counts.values()), counts[""]), counts


def cost_by_hand(m, counts, text):
    """Bits of a text under a model, unit by unit and bit by bit."""
    top = sorted((w for w, n in counts.items() if w and n > 1), key=lambda w: (-counts[w], w.encode()))[: M.CODED]
    rank = {"": 0} | {w: k + 1 for k, w in enumerate(top)}
    escape = len(top) + 1
    bits = 0.0

    def slot(k, context, node):
        h = (context * 0x9E3779B1 & 0xFFFFFFFF) ^ (node * 0x85EBCA6B + k * 0x27D4EB2F & 0xFFFFFFFF)
        h ^= h >> 15
        return (h * 0xC2B2AE35 & 0xFFFFFFFF) >> (32 - m.book.slot_bits)

    def price(which, contexts, node, phase, place, bit):
        z = 0.0
        for k in which:
            code = int(m.codes[k][slot(k, contexts[k], node)])
            z += float(m.mixer.weights[k, phase, code // 256]) * (code % 256 - 128) / 10
        z = round(max(-12, min(12, z)) * 64) / 64
        hits = m.mixer.hits[place] + m.mixer.start
        step = max(-16, min(16, round(z * 2))) + 16
        p = 0.5 / (1 + math.exp(-z)) + 0.5 * hits[step][1] / hits[step].sum()
        return -math.log2(p if bit else 1 - p)

    near = far = skip = None
    shape = 128
    for gap, word in units(text):
        raw = word.encode()
        kind, r = GAPS.get(gap, 7), rank.get(word, escape)
        one, two, three = (2557 if near is None else near), (317 if far is None else far[0]), (2557 if skip is None else skip)
        before = 317 if far is None or far[1] is None else far[1]
        early = [0, one, two * 512 + before, three, shape * 8]
        late = [*early[:4], shape * 8 + kind]
        prefix = [int(kind != 0)] + ([kind >> 2 & 1, kind >> 1 & 1, kind & 1] if kind else [])
        for j, bit in enumerate(prefix):
            bits += price([1, 3, 4], early, 1 if not j else 8 | kind >> (4 - j) | 16 << j, 0, j, bit)
        if kind == 7:
            bits += (len(gap) + 1) * math.log2(7)
        n, code = int(m.book.sizes[r]), int(m.book.codes[r])
        for j in range(n):
            which = [k for k, reach in enumerate(M.REACH) if j < reach]
            bits += price(which, late, (1 << j | code >> (n - j)) + 256, 1 if j < 5 else 2 if j < 7 else 3, 4 + min(j, 27), code >> (n - j - 1) & 1)
        if r == escape:
            data = np.frombuffer(raw + b" ", np.uint8)
            bits += float(m.spelling.cost(data, np.zeros(1, np.int64), np.array([len(raw)]))[0])
        tail = raw[-1] if raw else 0
        tails = tail + 256 * (raw[-2] if len(raw) > 1 else 0)
        skip = near
        near = r if r < M.NEAR else M.NEAR + tails * 0x9E37 % 509
        far = (r if r < M.FAR else M.FAR + tail % 61, None if far is None else far[0])
        shape = min(len(raw), 15) + 16 * kind
    return bits


def sentences(rng, n):
    """Texts in which each word allows only a few next ones."""
    vocab = [f"w{i}x" for i in range(60)]
    out = []
    for _ in range(n):
        w = [int(rng.integers(60))]
        for _ in range(120):
            w.append((w[-1] * 7 + int(rng.integers(3))) % 60)
        out.append(" ".join(vocab[x] for x in w))
    return out


def test_score_matches_a_scorer_by_hand(spark):
    rng = np.random.default_rng(8)
    texts = sentences(rng, 40) + [t for _, t in rows() if t]
    m, counts = trained(spark, texts)
    tests = ["", " ", "W1x w7x", "w1x  w7x\n\nw49x\t\r\n neverseen w1x \n ", texts[0][:200], "é日本 w3x", rows()[1][1], rows()[4][1]]
    for t in tests:
        raw = M.lower(t)
        got = m.cost(np.frombuffer(raw + b"\n", np.uint8), np.zeros(1, np.int64))[0][0]
        want = cost_by_hand(m, counts, t)
        assert abs(got - want) < 1e-3 * (1 + want), t
    joined = [M.lower(t) for t in tests]
    begin = np.cumsum([0, *[len(t) + 1 for t in joined]])[:-1]
    together = m.cost(np.frombuffer(b"\n".join(joined) + b"\n", np.uint8), begin)[0]
    assert np.allclose(together, [m.cost(np.frombuffer(t + b"\n", np.uint8), np.zeros(1, np.int64))[0][0] for t in joined], rtol=1e-4)


def test_order_of_words_matters(spark):
    rng = np.random.default_rng(5)
    m, counts = trained(spark, sentences(rng, 150))
    known = sum(counts.values())

    def bits(texts):
        raw = [M.lower(t) for t in texts]
        return float(m.cost(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8), np.cumsum([0, *[len(t) + 1 for t in raw]])[:-1])[0].sum())

    held = sentences(rng, 20)
    mixed = [" ".join(rng.permutation(t.split())) for t in held]
    words = sum(-math.log2((counts[w] + 1) / (known + len(counts) + 1)) for t in held for w in tokens(t))
    assert bits(held) < 0.8 * words < 0.95 * bits(mixed)


def test_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(6)
    m, _ = trained(spark, sentences(rng, 60))
    # of all codes after the same word and white space
    total = 0.0
    for r in range(len(m.book.codes)):
        data = np.frombuffer(b"w5x w7x\n", np.uint8)
        u = M.Units(m.book, data, np.zeros(1, np.int64))
        u.rank[1] = r
        bits = 0.0
        for at, phase, place, bit, which, slots in u.steps(m.book, 1, 2):
            if phase and len(at):
                z = sum(m.weighted(k, phase)[s[0]] for k, s in zip(which, slots, strict=True))
                bits += float(m.prices[2 * place + bit[0], M.fine(z)])
        total += 2.0**-bits
    assert abs(total - 1) < 1e-4
    # of all bytes after the same start of a spelled word
    total = 0.0
    for c in range(256):
        symbols = np.array([97, c], np.uint32)
        bits = 0.0
        for node, bit, slots in M.steps(symbols, np.arange(2)):
            z = sum(t[x[1:]] for t, x in zip(m.spelling.tables, slots, strict=True))
            bits += float(m.spelling.prices[2 * node[1:] + bit[1:], M.fine(z)][0])
        total += 2.0**-bits
    assert abs(total - 1) < 1e-4


def test_languages_and_spans(spark):
    en = "the quick brown fox jumps over the lazy dog and then it runs away from the hunters in the forest"
    fr = "le renard brun saute par dessus le chien paresseux et puis il court loin des chasseurs dans la forêt"
    ru = "быстрая лиса прыгает через ленивую собаку и убегает от охотников"
    train = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([(en, "en"), (fr, "fr"), (ru, "ru")] * 5)], "doc_id long, text string, lang string")
    model = L.fit(train, "doc_id", "text", "lang")
    pairs = rows() + [(1, en), (2, fr.upper()), (3, ru), (4, en + ". " + fr), (5, "12 34 !"), (6, "日本語")]
    got = L.identify(frame(spark, pairs), model).collect()
    last = {r["doc_id"]: r for r in got[-6:]}
    assert [last[i]["lang_pred"] for i in (1, 2, 3, 5)] == ["en", "fr", "ru", "und"] and last[6]["lang_pred"] in ("en", "fr", "ru")
    assert [s["lang"] for s in last[4]["spans"]] == ["en", "fr"] and abs(last[4]["spans"][1]["start"] - len(en) - 2) < 12
    assert len(got) == len(pairs) and all(0 <= r["score"] <= 1 for r in got)
    assert next(r for r in got if r["doc_id"] == 1000)["lang_pred"] == "und"
    assert last[6]["score"] == 0 and all(last[i]["score"] > 0.9 for i in (1, 2, 3))
    assert L.identify(frame(spark, [(1, "\U00030000\U00030001 x")]), model).first()["lang_pred"] != "und"
    assert L.identify(frame(spark, []), model).count() == 0
    none = L.fit(frame(spark, []), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in L.identify(frame(spark), none).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.normal(0, 4, (6, 3)).astype(np.float32)
        value = lambda path: sum(s[t, k] for t, k in enumerate(path)) - 5 * sum(a != b for a, b in zip(path, path[1:], strict=False))  # noqa: B023, E731
        best = max(value(p) for p in product(range(3), repeat=6))
        assert abs(value(tuple(L.label_words(s, 5.0))) - best) < 1e-3


def test_quality_scores(spark):
    rng = np.random.default_rng(4)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 40)) for _ in range(60)]
    bad = [" ".join(rng.choice(["$$$", "buy|", "%%x", "!!now"], 40)) for _ in range(60)]
    pairs = [(i, t) for i, t in enumerate(good[:50] + bad[:50])]
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(100)], "doc_id long, quality int")
    model = Q.fit(frame(spark, pairs), labels)
    test = [(i, t) for i, t in enumerate(good[50:] + bad[50:])] + rows()
    got = Q.score(frame(spark, test), model).collect()
    assert [r["predicted"] for r in got[:20]] == [1] * 10 + [0] * 10
    assert len(got) == len(test) and all(0 <= r["score"] <= 1 for r in got)
    again = Q.score(frame(spark, test).repartition(7), model).collect()
    assert Counter((r["doc_id"], round(r["score"], 5)) for r in got) == Counter((r["doc_id"], round(r["score"], 5)) for r in again)
    assert {r["score"] for r in Q.score(frame(spark), Q.fit(frame(spark), labels.limit(0))).collect()} == {0.5}
    assert Q.score(frame(spark, []), model).count() == 0
    # an id with several rows and labels trains alike whatever their order
    twice = pairs + [(i, t + " more") for i, t in pairs[:9]]
    odd = labels.unionByName(spark.createDataFrame([(i, 0) for i in range(5)], "doc_id long, quality int"))
    one, two = Q.fit(frame(spark, twice), odd), Q.fit(frame(spark, twice[::-1]).repartition(5), odd.repartition(3))
    assert np.array_equal(one.logit, two.logit) and one.bias == two.bias
    # the mean of the features' logits, by hand
    for text, r in zip([t for _, t in test[:3]], got[:3], strict=True):
        h = Q.buckets(np.array([*map(ord, text), 10], np.uint32))[0]
        assert abs(r["score"] - 1 / (1 + np.exp(-(model.logit[h].astype(float).mean() + model.bias)))) < 1e-5


def test_pieces_of_a_long_text_give_its_features(monkeypatch):
    rng = np.random.default_rng(1)
    p = rng.choice(np.array([32, 32, 97, 98, 99, 10, 300]), 20_000).astype(np.uint32)
    p[5000:9000], p[-1] = 97, 10
    want = np.bincount(Q.buckets(p)[0], minlength=Q.BUCKETS + 1)
    for size in (50, 777, 5000):
        monkeypatch.setattr(Q, "PIECE", size)
        assert (sum(np.bincount(h, minlength=Q.BUCKETS + 1) for h in Q.pieces(p)) == want).all()


def test_training_follows_the_gradient():
    """A step moves vectors and weights against the gradient of the averaged softmax's loss, measured by differences."""
    samples = [(1, np.array([3, 5, 8]), np.array([2, 1, 1])), (0, np.array([5, 9]), np.array([1, 3]))]
    dim, seed = 4, 5
    made = np.random.default_rng(seed)
    embed = (made.random((Q.BUCKETS + 1, dim)) - 0.5) / dim
    weight, bias = made.normal(0, 0.1, (2, dim)), np.zeros(2)
    steps = 0
    for _ in range(3):
        for i in made.permutation(2):
            y, idx, n = samples[i]
            lr = 0.5 * (1 - steps / 6)
            steps += 1

            def loss(e, w, b, y=y, idx=idx, n=n):
                z = w @ ((n / n.sum()) @ e) + b
                return (np.log(np.exp(z).sum()) - z[y]) * 0.5 / 0.5

            def slope(f, x, h=1e-5):
                out = np.zeros_like(x)
                for k in np.ndindex(x.shape):
                    up, down = x.copy(), x.copy()
                    up[k] += h
                    down[k] -= h
                    out[k] = (f(up) - f(down)) / (2 * h)
                return out

            own = embed[idx].copy()
            de, dw, db = slope(lambda e: loss(e, weight, bias), own), slope(lambda w: loss(own, w, bias), weight), slope(lambda b: loss(own, weight, b), bias)  # noqa: B023
            embed[idx] -= lr * Q.EMBED * de
            weight, bias = weight - lr * dw, bias - lr * Q.BIAS * db
    model = Q.train(samples, dim=dim, epochs=3, rate=0.5, seed=seed)
    want = embed @ (weight[1] - weight[0])
    assert np.allclose(model.logit, want, atol=1e-3) and abs(model.bias - (bias[1] - bias[0])) < 1e-4


def test_mixing_counts_have_no_bound(spark):
    # two tasks' counts of the same slots, over 2^32 together and alone
    big = np.zeros((1, 64), np.uint64)
    big[0, :3] = 3_000_000_000, 5_000_000_000, 7
    block = [np.split(big[0], M._BLOCKS)[b] for b in range(M._BLOCKS)]
    parts = [(b, g, bytearray(M._packed(x))) for b, x in enumerate(block) for g in (0, 1)]
    got = M._summed(spark.createDataFrame(parts, "part int, g int, n binary"), (1, 64))
    assert got[0, :4].tolist() == [6e9, 1e10, 14, 0]
    assert len(M._packed(block[1])) == 4 * 8 and len(M._packed(block[0])) == 8 * 8


def test_spelling_weighs_words_by_the_root_of_their_counts(spark):
    counts = np.zeros((len(M.ORDERS), 2 * M.SLOTS), np.float32)
    words = spark.createDataFrame([(bytearray(b"ab"), 10_000)], "word binary, n long")
    assert M.mixed_spelling(words, counts).hits.sum() == pytest.approx(100 * 3 * 8)  # 8 bits of each of 3 symbols


def test_every_training_unit_is_counted(spark):
    texts = ["a b a\n\nc zz", "", "a b q", "a a a b b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = M.word_counts(df).cache()
    total, units = sum(r["n"] for r in words.collect()), sum(len(t.split()) + 1 for t in texts)
    top = words.where("word <> X'' AND n > 1").orderBy(F.desc("n"), "word").toPandas()
    book = M.Book([bytes(w) for w in top["word"]], top["n"].tolist(), total, len(texts))
    assert total == units
    counts = M.unit_counts(df, book)
    data = np.frombuffer(b"".join(M.lower(t) + b"\n" for t in texts), np.uint8)
    begin = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    u = M.Units(book, data, begin)
    bits = book.sizes[u.rank].sum()
    assert len(u) == units and counts[0].sum() == bits  # the first predictor takes every bit of every word


def test_work_that_is_alike_is_done_once(monkeypatch):
    rng = np.random.default_rng(4)
    words = [bytes(rng.choice(list(b"abcd"), n)) for n in rng.integers(1, 12, 400)]
    size = np.array([len(w) for w in words])
    ends = np.cumsum(size)
    data = np.frombuffer(b"".join(words) + b" ", np.uint8)
    spelling = M.Spelling(rng.integers(0, 50, (len(M.ORDERS), 2 * M.SLOTS)).astype(np.float32), M.Mixer(len(M.ORDERS), 1, 256))
    symbols, place, first = M.spell(data, ends - size, ends)
    want = np.zeros(len(symbols), np.float32)
    for node, bit, slots in M.steps(symbols, place):
        z = spelling.tables[0][slots[0]]
        for t, s in zip(spelling.tables[1:], slots[1:], strict=True):
            z = z + t[s]
        want += spelling.prices[2 * node + bit, M.fine(z)]
    priced = []
    one = M.Spelling._new_cost
    monkeypatch.setattr(M.Spelling, "_new_cost", lambda self, a, b, every: (priced.append(len(every)), one(self, a, b, every))[1])
    for _ in range(2):
        assert np.array_equal(spelling.cost(data, ends - size, ends), np.add.reduceat(want.astype(float), first))
    known = {(w[max(i - 6, 0) : i], min(i, 6), w[i : i + 1]) for w in words for i in range(len(w) + 1)}
    assert sum(priced) == len(known) < len(symbols)


def test_a_predictor_alone_learns_as_in_company():
    rng = np.random.default_rng(6)
    x, bit = rng.integers(0, M.CONFIDENCE * 256, 5000).astype(np.uint16), rng.integers(0, 2, 5000)
    a, b = M.Mixer(2, 4, 32), M.Mixer(2, 4, 32)
    for _ in range(3):
        a.learn([x], [0], 3, 12, bit, None, 0.002)
        b.learn([x], [0], 3, 12, bit, np.ones(len(x)), 0.002)  # row by row
    assert np.allclose(a.weights, b.weights, rtol=0, atol=1e-12) and np.array_equal(a.hits, b.hits) and a.bits == b.bits


def test_alike_symbols_are_counted_and_learned_from_once():
    words = [b"abc", b"abd", b"abc", b"xabcdefgh", b"yabcdefgh", b"", b"abc"]
    size = np.array([len(w) for w in words])
    ends = np.cumsum(size)
    symbols, place, _ = M.spell(np.frombuffer(b"".join(words) + b" ", np.uint8), ends - size, ends)
    weight = np.repeat(np.arange(1.0, 8), size + 1)
    alike, ctx, n = M.alike(symbols, place, weight)
    seen = [(w[max(i - 6, 0) : i], min(i, 6), (w + b" ")[i : i + 1] if w else b"\0") for w in words for i in range(len(w) + 1)]
    assert len(alike) == len(n) == len(set(seen)) < len(symbols) and n.sum() == weight.sum()
    one, all_ = np.zeros((len(M.ORDERS), 2 * M.SLOTS)), np.zeros((len(M.ORDERS), 2 * M.SLOTS))
    for total, steps, w in ((one, M.bit_steps(alike, ctx), n), (all_, M.steps(symbols, place), weight)):
        for _, bit, slots in steps:
            for k, s in enumerate(slots):
                np.add.at(total[k], 2 * s + bit, w)
    assert np.array_equal(one, all_)


def test_shared_bits_need_no_path_of_codes():
    rng = np.random.default_rng(7)
    words = sorted({bytes(rng.choice(list(b"abcdefgh"), 4)) for _ in range(900)})
    counts = sorted((int(x) for x in 3000 / np.arange(1, len(words) + 1) + 2), reverse=True)
    book = M.Book(words, counts, sum(counts) + 5000, 100)
    data = np.frombuffer(b" ".join(rng.permutation(np.array([*words, b"never", b"seen!"], object))) + b"\n", np.uint8)
    u = M.Units(book, data, np.zeros(1, np.int64))
    shared = list(u.steps(book, shared=True))
    assert "path" not in book.__dict__
    first, place, bits, _, slot = book.path
    got = 0
    for at, phase, j, bit, which, slots in shared:
        if phase:
            here = first[u.rank[at]] + j - 4
            assert (place[here] == j - 4).all() and (bits[here] == bit).all() and (book.roots[slots[0]] == slot[here]).all() and which[0] == 0
            got += len(at)
    assert got == np.minimum(book.sizes[u.rank], M.SHARED).sum()
    assert sum(len(x[0]) for x in u.steps(book) if x[1]) == book.sizes[u.rank].sum()


def test_distinct_keys_and_spans():
    own, key, first = M._distinct(np.array([5, 3, 5, 9, 3], np.uint64))
    assert own.tolist() == [0, 1, 0, 2, 1] and key.tolist() == [5, 3, 9] and first.tolist() == [0, 1, 3]
    for raw in (b"", b"\n", b"a\n", b"  a b\x08\x0e\x1f\t\xff\n", bytes(range(256)) + b" "):
        starts, ends = M.word_spans(np.frombuffer(raw, np.uint8))
        want = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want


def test_words_of_several_slices_are_counted(spark):
    texts = ["x " * 700_000, None, "y x\u00e9 " * 200_000 + "Z", "", "z y"]  # over 1,000,000 bytes: more slices than one
    got = {bytes(r["word"]).decode(): r["n"] for r in M.word_counts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).collect()}
    assert got == dict(Counter(w for t in texts for w in tokens(t or "")))
