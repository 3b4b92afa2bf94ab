"""Nested metadata documents: parsing, keyword predicates and the routing of keyword groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = (
    "identification struct<accessconstraints:string, rights:string, license:string, "
    "keywords:map<string, struct<keywords_type:string, vocabulary:struct<name:string>, keywords:array<string>>>>"
)


def parse(text: Column) -> Column:
    """The document, or NULL where the text is not valid JSON."""
    return F.from_json(text, SCHEMA)


def keywords(doc: Column) -> Column:
    """All keywords of all groups."""
    groups = F.map_values(doc["identification"]["keywords"])
    none = F.array().cast("array<string>")
    return F.coalesce(F.flatten(F.transform(groups, lambda g: F.coalesce(g["keywords"], none))), none)


def license_name(doc: Column) -> Column:
    """The name of a licence given as an object, else the licence itself."""
    x = doc["identification"]["license"]
    return F.coalesce(F.get_json_object(x, "$.name"), x)


def is_open_data(words: Column) -> Column:
    norm = lambda w: F.regexp_replace(F.translate(F.lower(F.trim(w)), "-_", "  "), r"\s+", " ")
    return F.exists(words, lambda w: norm(w).contains("opendata") | norm(w).contains("open data"))


def mentions(title: Column, abstract: Column, words: Column, part: str) -> Column:
    has = lambda x: F.coalesce(F.lower(x).contains(part), F.lit(False))
    return has(title) | has(abstract) | F.exists(words, has)


# The codelist of scopes, and vocabularies whose keywords are places.
SCOPE_VOCABULARY = "spatial scope"
PLACE_VOCABULARIES = ["country", "region", "continents, countries, sea regions of the world.", "continents, countries and sea regions of the world."]


def route(vocabulary: Column, kind: Column) -> Column:
    """The band of a keyword group: scope tags first, then place keywords, else dropped."""
    norm = lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(norm(vocabulary) == SCOPE_VOCABULARY, "scope_tag").when((norm(kind) == "place") | norm(vocabulary).isin(PLACE_VOCABULARIES), "place_keyword").otherwise("dropped")
