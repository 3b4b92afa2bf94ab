"""Labels and free text as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def present(x: Column) -> Column:
    """Neither NULL nor the empty string."""
    return x.isNotNull() & (x.cast("string") != "")


def cell(x: Column) -> Column:
    """A CSV cell: trimmed; empty or the word NULL is missing."""
    t = F.trim(x)
    return F.when(F.upper(t).isin("", "NULL"), None).otherwise(t)


def label_key(x: Column, inner: bool = True) -> Column:
    """A label without leading digits; with ``inner`` also without the space that followed them."""
    bare = F.regexp_replace(F.ltrim(x), "^[0-9]+", "")
    return F.ltrim(bare) if inner else bare


def clean_definition(x: Column) -> Column:
    flat = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.trim(F.regexp_replace(flat, r"\s*Source:\s.*$", ""))


def enriched(label: Column, definition: Column) -> Column:
    return F.when(present(definition), F.concat(label, F.lit(": "), definition)).otherwise(label)


def primary_label(labels: Column, identifier: Column, lang: str = "en") -> Column:
    """The first label in ``lang``, else the first of any language, else the identifier."""
    return F.coalesce(F.get(F.try_element_at(labels, F.lit(lang)), F.lit(0)), F.get(F.flatten(F.map_values(labels)), F.lit(0)), identifier)


def merge_labels(a: Column, b: Column) -> Column:
    """Two maps of language to labels as one; labels keep their order and occur once."""
    none = F.array().cast("array<string>")
    return F.map_zip_with(a, b, lambda k, x, y: F.array_distinct(F.concat(F.coalesce(x, none), F.coalesce(y, none))))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one row of the table per character, each the running maximum of its candidates."""
    chars = lambda x: F.filter(F.split(x, ""), lambda c: c != "")

    def rows(cs: Column) -> Column:
        def row(last: Column, x: Column) -> Column:
            best = F.transform(cs, lambda c, j: F.greatest(F.get(last, j), F.coalesce(F.get(last, j - 1), F.lit(0)) + F.when(c == x, 1).otherwise(0)))
            return let(best, lambda v: F.transform(v, lambda _, j: F.array_max(F.slice(v, F.lit(1), j + 1))))

        start = F.transform(cs, lambda _: F.lit(0))
        return F.coalesce(F.element_at(F.aggregate(chars(a), start, row), -1), F.lit(0))

    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(let(chars(b), rows))


def similarity(a: Column, b: Column) -> Column:
    """0 to 100: twice the common subsequence over both lengths, halves to even; two empty texts are alike."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 100).otherwise(F.bround(F.lit(200.0) * common_length(a, b) / both, 0).cast("int"))


def words(x: Column) -> Column:
    """Distinct words in order."""
    return F.array_distinct(F.filter(F.split(x, r"[ ,.!;:]+"), lambda w: w != ""))


def strip_noise(x: Column) -> Column:
    """Without tags, links and DOIs; white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", " "), r"https?://\S+", " "), r"10\.\d{4,9}/\S+", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def chunks(x: Column, low: int, high: int) -> Column:
    """Sentences packed left to right: one joins the chunk before it while that is under ``low`` and both fit ``high``; a short last chunk joins its predecessor."""
    sentences = F.split(x, r"(?<=[.!?])\s+(?=[A-ZÄÖÜ])")
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(s: Column, t: Column) -> Column:
        joined = F.when(s["open"] == "", t).otherwise(F.concat(s["open"], F.lit(" "), t))
        fits = (F.length(s["open"]) < low) & (F.length(joined) <= high) | (s["open"] == "")
        return F.struct(F.when(fits, s["done"]).otherwise(F.array_append(s["done"], s["open"])).alias("done"), F.when(fits, joined).otherwise(t).alias("open"))

    def close(s: Column) -> Column:
        tail = (F.length(s["open"]) < low) & (F.size(s["done"]) > 0)
        merged = F.concat(F.slice(s["done"], F.lit(1), F.size(s["done"]) - 1), F.array(F.concat(F.element_at(s["done"], -1), F.lit(" "), s["open"])))
        return F.when(s["open"] == "", s["done"]).when(tail, merged).otherwise(F.array_append(s["done"], s["open"]))

    return F.aggregate(sentences, state, step, close)


def has_term(text: Column, term: str) -> Column:
    """Whether a term occurs in lower-cased text with no letter beside it."""
    return F.lower(text).rlike(rf"(?<![a-z])\Q{term.lower()}\E(?![a-z])")


def terms_in(text: Column, terms: list[str]) -> Column:
    """The terms that occur, in the order given."""
    return F.array_compact(F.array(*[F.when(has_term(text, t), F.lit(t)) for t in terms]))


def mask_thematic(text: Column, nouns: list[str]) -> Column:
    """``global`` and ``worldwide`` before one of ``nouns`` no longer read as a scope."""
    return F.regexp_replace(text, rf"(?i)\b(global|worldwide)(?=\s+(?:{'|'.join(nouns)})\b)", "x$1")


def iso_language(x: Column, table: list[tuple[str, str]]) -> Column:
    """The two-letter code of a language: by its own code or as a part of the longer codes; the first entry wins, NULL and empty give NULL."""
    t = F.lower(F.trim(x))
    out = F.when(~present(t), None)
    for two, codes in table:
        out = out.when((t == two) | F.lit(codes).contains(t), two)
    return out


def orcid_date(y: Column, m: Column, d: Column) -> Column:
    """A partial date: a missing month or day is the first; what is no date is NULL."""
    part = lambda x, least: F.coalesce(x.cast("string"), F.lit(str(least)))
    return F.concat_ws("-", F.lpad(part(y, 1), 4, "0"), part(m, 1), part(d, 1)).try_cast("date")
