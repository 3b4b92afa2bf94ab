"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document; the ledger row holds the failure bits and the
measurements behind them. Policies (versioned sets of rules) and ablations are then bitwise
operations on the ledger, without another look at any text.

Null text counts as empty (no words); an empty text fails ``few_words``. Repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"[\x20\x09-\x0D]+"

#: Rules in the order of their bits: a document fails where the condition on its measurements holds.
RULES: dict[str, Callable[[dict[str, Column]], Column]] = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > 3 * m["n_words"],
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"]),
    "capitals": lambda m: 10 * m["n_capitals"] > 6 * m["word_chars"],
    "exclamations": lambda m: 2 * m["n_exclamations"] > m["n_words"],
}
BITS = {name: k for k, name in enumerate(RULES)}
#: A policy is the set of rules that reject; versions are never edited, only added.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "v2": list(RULES),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are sorted with their places, so equal ones are neighbours; the places of repeated
    windows in order then give the words they cover: three for the first, and for each next one
    as many as it lies further on, three at most.
    """

    def covered(s: Column) -> Column:
        places = F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(F.get(s, j)["g"] == F.get(s, j - 1)["g"], F.lit(False)) | F.coalesce(F.get(s, j)["g"] == F.get(s, j + 1)["g"], F.lit(False))),
            lambda j: F.get(s, j)["i"],
        )
        return F.aggregate(
            F.sort_array(places),
            F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n")),
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"].cast("long"),
        )

    def windows(w: Column) -> Column:
        one = lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))
        return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), one)), covered))

    return let(words, windows)


def measurements(text: Column) -> dict[str, Column]:
    """The measurements by name, as expressions on a non-null text."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    bare = F.regexp_replace(text, _SPACE, "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    row = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    return {
        "words": both, "lines": row, "word_chars": F.length(bare).cast("long"), "n_symbols": count("#*$%&|<>"),
        "n_capitals": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "n_exclamations": count("!"),
    }


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the measurements and ``failures`` (one bit per rule), one row per row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(F.col(id_col), *[c.alias(n) for n, c in measurements(text).items()])
    flat = raw.select(
        id_col, F.col("words.n").alias("n_words"), "word_chars", "n_symbols", F.col("lines.d").alias("n_dup_lines"), F.col("words.r").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"), "n_capitals", "n_exclamations",
    )
    m = {c: F.col(c) for c in flat.columns}
    bits = [F.when(rule(m), F.lit(1 << BITS[name])).otherwise(F.lit(0)).cast("long") for name, rule in RULES.items()]
    return flat.withColumn("failures", reduce(lambda a, b: a.bitwiseOR(b), bits))


def mask(version: str) -> int:
    return sum(1 << BITS[name] for name in POLICIES[version])


def rejected(failures: Column, version: str) -> Column:
    """Whether a policy rejects a document, from its failure bits."""
    return failures.bitwiseAND(F.lit(mask(version))) != 0


def ablation(rows: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects; one pass over the ledger."""
    own = F.col("failures").bitwiseAND(F.lit(mask(version)))
    found = rows.groupBy(own.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** rules rows
    parts = [F.struct(F.lit(r).alias("rule"), F.lit(1 << BITS[r]).cast("long").alias("bit")) for r in POLICIES[version]]
    flat = found.select("n", "bits", F.explode(F.array(*parts)).alias("r")).where(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
    return flat.groupBy(F.col("r.rule").alias("rule")).agg(F.sum("n").alias("failed"), F.sum(F.when(F.bit_count("bits") == 1, F.col("n")).otherwise(0)).alias("only_this"))
