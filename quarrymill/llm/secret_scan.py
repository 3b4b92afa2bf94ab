"""Secret scans in DataFrame functions only.

Three fixed patterns give the base spans. Beyond them, runs of token characters are compared
under two character Markov models, one of random strings and one of ordinary identifiers. Both
are bigram counts from labelled samples (token, label: 1 random, 0 ordinary; ``default_samples``
takes the words of all texts). A run is marked if
its log-likelihood ratio reaches ``MIN_RATIO`` in all and ``MIN_MEAN`` a pair of characters, so that
neither a long ordinary run nor a short odd one passes. Numbers, dates, paths, version strings,
UUIDs and repeated characters count as ordinary: what they hold is no key. Shorter runs of hex
digits than the base pattern takes can't be told from these and are left alone.

Null text counts as empty and has no spans. Places are code points, ends exclusive. Of base spans
that start together the kinds go in the order of ``KINDS``; an added span overlaps no base span, and
added ones don't overlap each other. Repeated rows are each scanned; an empty table gives an empty
result, and without documents the samples are those generated here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality_rules import let

# The base patterns and the least lengths of their matches.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6
#: Runs that the Markov models judge.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ["assign", "access", "hex", "random"]
FIRST, CODES = 43, 80  # '+' to 'z'
#: Least log-likelihood ratio of a marked run: in all, and a pair of characters.
MIN_RATIO, MIN_MEAN = 14.0, 0.8

#: Parts of ordinary identifiers for the default samples.
PARTS = ("get set user name list index count value data file path config request response handler manager service client server error message "
         "buffer stream string number version default update create delete build parse format token table column record query result model "
         "session context event listener factory controller repository database connection transaction").split()  # fmt: skip


def _prefix_sums(a: Column) -> Column:
    """Inclusive prefix sums of an array, in rounds of doubled reach."""
    rounds = F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)).cast("double"))).cast("int")
    step = lambda acc, k: F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - F.pow(F.lit(2.0), k).cast("int")), F.lit(0)))
    return F.aggregate(F.sequence(F.lit(0), rounds), a, step)


def find(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,hit>>: lengths of matches and of what lies between, summed up."""

    def place(h: Column) -> Column:
        between = F.split(text, pattern, -1)
        ends = let(between, lambda p: _prefix_sums(F.transform(h, lambda x, i: F.length(F.get(p, i)) + F.length(x))))
        return let(ends, lambda e: F.transform(h, lambda x, i: F.struct((F.get(e, i) - F.length(x)).alias("start"), F.get(e, i).alias("end"), x.alias("hit"))))

    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda h: F.when(F.size(h) == 0, empty).otherwise(place(h)))


def default_samples(docs: DataFrame, id_col: str, text_col: str, n_each: int = 1500, max_docs: int = 500) -> DataFrame:
    """(token, label, n, weight): generated keys as random strings; composed names, paths, numbers and the like, and the words of all texts, as ordinary ones.

    A token counts n times ``weight``. The words together weigh as those of ``max_docs`` average texts, if there are more.
    """
    spark: SparkSession = docs.sparkSession
    key = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(key)), "=", "")
    plain = F.regexp_replace(base64, "[+/]", "")
    digits = F.translate(key, "abcdef", "314159")
    part = lambda k: F.element_at(F.array(*[F.lit(p) for p in PARTS]), (F.abs(F.xxhash64(F.lit(k), "id")) % len(PARTS) + 1).cast("int"))
    number = lambda k, n: (F.abs(F.xxhash64(F.lit(k), "id")) % n).cast("string")
    two = lambda k, n: F.lpad(number(k, n), 2, "0")
    day = lambda mark: F.concat_ws(mark, F.concat(F.lit("20"), two(11, 40)), two(12, 13), two(13, 32))
    cut = lambda t: F.substring(t, F.lit(1), (20 + F.col("id") % 21).cast("int"))
    upper = F.concat(*[F.chr(F.lit(65) + F.abs(F.xxhash64(F.lit(k), "id")) % 26) if k % 3 else number(k, 10) for k in range(100, 130)])
    random = [cut(plain), cut(plain), cut(base64), cut(F.translate(base64, "+/", "-_")), cut(upper)]
    snake, camel = F.concat_ws("_", part(1), part(2), part(3)), F.concat(part(1), F.initcap(part(2)), F.initcap(part(3)))
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    letter = lambda k: F.substring(F.lit(alphabet), (F.abs(F.xxhash64(F.lit(k), "id")) % len(alphabet) + 1).cast("int"), F.lit(1))
    ordinary = [
        snake, camel, F.initcap(camel), F.concat(F.upper(snake), F.lit("_"), number(4, 100)), F.concat(camel, number(5, 1000)),
        F.concat_ws("-", part(1), part(2), F.concat(part(3), number(6, 30))), F.concat(F.lit("/"), F.concat_ws("/", part(1), F.concat(part(2), number(7, 10)), part(3), snake)),
        F.concat_ws("/", part(1), F.concat_ws("-", part(2), part(3)), day("/"), snake), F.concat_ws("_", part(1), day("-"), number(8, 100_000)), F.concat(day(""), F.lit("-"), two(14, 24), two(15, 60), two(16, 60)),
        cut(digits), cut(F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 4), F.substring(digits, 9, 4), F.substring(digits, 13, 4), F.substring(digits, 17, 4))), F.concat(F.lit("+"), F.substring(digits, 1, 16)),
        F.concat_ws("-", F.substring(key, 1, 8), F.substring(key, 9, 4), F.substring(key, 13, 4), F.substring(key, 17, 4), F.substring(key, 21, 12)),
        F.repeat(letter(17), 20), F.repeat(F.concat(letter(18), letter(19)), 10), F.substring(F.lit(alphabet), (F.col("id") % 42 + 1).cast("int"), F.lit(20)),
    ]
    made = [(t, 1) for t in random] + [(t, 0) for t in ordinary]
    names = spark.range(n_each).select(F.explode(F.array(*[F.struct(t.alias("token"), F.lit(y).alias("label")) for t, y in made])).alias("x")).select("x.token", "x.label")
    text = docs.select(F.col(text_col).alias("text")).where("text is not null")
    share = min(1.0, max_docs / max(text.count(), 1))
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = text.select(F.explode(F.regexp_extract_all(clean, F.lit("[A-Za-z]{4,}"), F.lit(0))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    words = words.select(F.explode(F.array(F.struct(F.col("t").alias("token"), F.lit(0).alias("label"), "n"), F.struct(F.upper("t").alias("token"), F.lit(0).alias("label"), "n"))).alias("x")).select("x.token", "x.label", "x.n", F.lit(share).alias("weight"))
    names = names.select("token", "label", F.lit(1).cast("long").alias("n"), F.lit(1.0).alias("weight"))
    return names.unionByName(words)


def _code(text: Column, at: Column) -> Column:
    return F.ascii(F.substring(text, at, F.lit(1))) - FIRST


def train(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratio of each pair of characters: random over ordinary, from bigram counts of labelled samples (each n times weight, if there are such columns)."""
    n, weight = (F.col(c) if c in samples.columns else F.lit(1) for c in ("n", "weight"))
    clean = samples.select(F.col("label").cast("int").alias("label"), n.cast("long").alias("n"), weight.cast("double").alias("weight"), F.explode(F.regexp_extract_all(F.col("token"), F.lit("[A-Za-z0-9+/_=-]{2,}"), F.lit(0))).alias("t"))
    pairs = clean.select("label", "n", "weight", F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: _code(F.col("t"), i) * CODES + _code(F.col("t"), i + 1))).alias("pair"))
    counts = [[smooth] * (CODES * CODES) for _ in range(2)]
    for label, pair, weight, n in sorted(pairs.groupBy("label", "pair", "weight").agg(F.sum("n")).collect()):  # an alphabet squared for each weight and label at most
        counts[label][pair] += weight * n
    table = []
    for a in range(CODES):
        rows = [c[a * CODES : (a + 1) * CODES] for c in counts]
        sums = [sum(r) for r in rows]
        table += [round(math.log(x / sums[1]) - math.log(y / sums[0]), 2) for x, y in zip(rows[1], rows[0], strict=True)]
    return table


def ratio(token: Column, table: list[float]) -> Column:
    """Sum of the pairs' log-likelihood ratios."""
    values = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda s, i: s + F.coalesce(F.get(values, _code(token, i) * CODES + _code(token, i + 1)), F.lit(0.0)))


def scan(docs: DataFrame, table: list[float], id_col: str = "doc_id", text_col: str = "text", min_ratio: float = MIN_RATIO, min_mean: float = MIN_MEAN, keep: list[str] | None = None) -> DataFrame:
    """``id_col`` (and ``keep``), and ``found``: array<struct<start,rank,kind,end>> of all spans by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = lambda spans, k: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(k)).alias("rank"), F.lit(k).alias("kind"), x["end"].alias("end")))
    assign = F.filter(find(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= ASSIGN_MIN)
    base = F.concat(kind(assign, "assign"), kind(find(text, ACCESS), "access"), kind(find(text, HEX), "hex"))
    runs = kind(F.filter(find(text, RUN), lambda x: ratio(x["hit"], table) >= F.greatest(F.lit(min_ratio), min_mean * (F.length(x["hit"]) - 1))), "random")
    fresh = lambda b: F.concat(b, F.filter(runs, lambda r: ~F.exists(b, lambda x: (x["start"] < r["end"]) & (r["start"] < x["end"]))))
    names = list(dict.fromkeys([id_col, *(keep or [])]))
    return docs.select(*[F.col(c) for c in names], F.array_sort(let(base, fresh)).alias("found"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scan's counts and span lists per row."""
    base = F.filter("found", lambda x: x["rank"] < 3)
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(id_col, *[count(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), count("random"))


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced; overlapping spans become one."""
    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        more = F.concat(a["out"], F.substring(text, a["end"] + 1, x["start"] - a["end"]), F.lit(mark))
        return F.struct(F.greatest(a["end"], x["end"]).alias("end"), F.when(x["start"] >= a["end"], more).otherwise(a["out"]).alias("out"))

    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(found, start, step, lambda a: F.concat(a["out"], F.substring(text, a["end"] + 1, F.length(text)))))
