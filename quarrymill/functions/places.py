"""Terms of European scope: routing of keywords, scans of free text, and the bands of evidence they form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import mask_thematic

# Countries of Europe by short name.
COUNTRIES = [
    "albania", "andorra", "austria", "belarus", "belgium", "bosnia and herzegovina", "bulgaria", "croatia", "cyprus", "czechia", "denmark", "estonia", "finland", "france", "germany", "greece",
    "hungary", "iceland", "ireland", "italy", "latvia", "liechtenstein", "lithuania", "luxembourg", "macedonia", "malta", "moldova", "monaco", "montenegro", "netherlands", "norway", "poland",
    "portugal", "romania", "russia", "san marino", "serbia", "slovakia", "slovenia", "spain", "sweden", "switzerland", "turkey", "ukraine", "united kingdom",
]
# Other names that authors use.
ALIASES = {
    "bundesrepublik deutschland": "germany", "deutschland": "germany", "czech republic": "czechia", "cesko": "czechia", "españa": "spain", "espana": "spain", "spanien": "spain",
    "finnland": "finland", "suomi": "finland", "italia": "italy", "italien": "italy", "nederland": "netherlands", "the netherlands": "netherlands", "russian federation": "russia",
    "russie": "russia", "uk": "united kingdom", "u.k.": "united kingdom", "great britain": "united kingdom", "britain": "united kingdom", "macedonia": "macedonia",
    "north macedonia": "macedonia", "fyrom": "macedonia", "bosnia": "bosnia and herzegovina", "republic of moldova": "moldova", "hellas": "greece", "hellenic republic": "greece",
}
# Labels that enumerate a European geography, and broad ones.
CONCRETE = ["eea39", "eea 39", "eea38", "eea 38", "eea38 (from 2020)", "eu28", "eu 28", "eu28 (2013-2020)", "eu27", "eu 27", "eu27 (2007-2013)", "eu27 (from 2020)", "eu25", "eu15", "efta4", "pan-eu", "pan eu", "eu-wide", "eu wide"]
BROAD = ["europe", "europa", "european union", "european", "global", "worldwide"]
# Nouns after which global and worldwide name a theme.
THEMES = [
    "warming", "change", "changes", "environmental", "fire", "fires", "radiation", "greenhouse", "methane", "nitrous", "biogeochemical", "biogeochemistry", "dilemma", "leaf", "leaves",
    "economy", "economic", "temperature", "temperatures", "dimming", "stabilization", "burned", "burning",
]
# Scope tags that mean many countries.
SCOPE_FOR = ["european", "global"]


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is evaluated one time, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _names() -> dict[str, str]:
    return ALIASES | {c: c for c in COUNTRIES}


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for pair in _names().items() for x in pair])


def route_values(values: Column) -> Column:
    """struct(concrete, broad, countries) of place keywords, each once, countries by short name; others are left out."""
    def routed(low: Column) -> Column:
        names = F.filter(F.transform(low, lambda v: F.try_element_at(_lookup(), v)), lambda v: v.isNotNull())
        return F.struct(F.array_intersect(low, _array(CONCRETE)).alias("concrete"), F.array_intersect(low, _array(BROAD)).alias("broad"), F.array_sort(F.array_distinct(names)).alias("countries"))

    return once(F.array_distinct(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.lower(F.trim(v)))), routed)


def split_places(text: Column) -> Column:
    """A comma-separated place description, routed."""
    return route_values(F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda v: F.trim(v) != ""))


def scope_votes(values: Column) -> Column:
    """struct(for, against) of scope tags, each once in order."""
    low = F.array_distinct(F.transform(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull() & (F.trim(v) != "")), lambda v: F.lower(F.trim(v))))
    return once(low, lambda v: F.struct(F.array_intersect(v, _array(SCOPE_FOR)).alias("for"), F.array_except(v, _array(SCOPE_FOR)).alias("against")))


def _pattern(terms: list[str], word: str) -> str:
    """Terms, longest first, with no ``word`` character beside them where they end in one."""
    import re

    def one(t: str) -> str:
        return re.sub(r"([.()+*?\[\]\\-])", r"\\\1", t) + (rf"(?!{word})" if re.search(r"\w$", t) else "")

    # what stands before a term is looked at once a place, not once a term
    begin, other = ([t for t in terms if bool(re.match(r"\w", t)) == inside] for inside in (True, False))
    listed = lambda own: "|".join(one(t) for t in sorted(own, key=lambda t: (-len(t), t)))
    return "|".join(p for p in ((rf"(?<!{word})(?:{listed(begin)})" if begin else ""), listed(other)) if p)


def scan(text: Column) -> Column:
    """struct(concrete, broad, countries) found in free text; NULL where there is none of them.

    Countries are found by Unicode word, other terms where no letter a-z stands beside them.
    """

    def found(low: Column) -> Column:
        every = lambda terms, word: F.array_sort(F.array_distinct(F.regexp_extract_all(low, F.lit(f"({_pattern(terms, word)})"), F.lit(1))))
        names = F.array_sort(F.array_distinct(F.transform(every(list(_names()), r"[\p{L}\p{N}_]"), lambda v: F.element_at(_lookup(), v))))
        return F.struct(every(CONCRETE, "[a-z]").alias("concrete"), every(BROAD, "[a-z]").alias("broad"), names.alias("countries"))

    out = once(F.lower(mask_thematic(F.coalesce(text, F.lit("")), THEMES)), found)
    return once(out, lambda v: F.when((F.size(v["concrete"]) > 0) | (F.size(v["broad"]) > 0) | (F.size(v["countries"]) > 0), v))
