"""Whether a record covers several European countries: evidence by band, pooled tiers, and the verdict with its votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.places import once, route_values, scan, scope_votes, split_places
from . import documents
from .spatial import agreement, bbox_vote, verdict

_NONE = "array<string>"


def _group_values(doc: Column, band: str) -> Column:
    """Keywords of the groups that are routed to a band."""
    groups = F.coalesce(F.map_values(doc["identification"]["keywords"]), F.array().cast("array<struct<keywords_type:string,vocabulary:struct<name:string>,keywords:array<string>>>"))
    own = F.filter(groups, lambda g: documents.route(g["vocabulary"]["name"], g["keywords_type"]) == band)
    return F.flatten(F.transform(own, lambda g: F.coalesce(g["keywords"], F.array().cast(_NONE))))


def evidence(doc: Column, title: Column, abstract: Column) -> Column:
    """struct(scope_tag, place_keyword, title, abstract) of parsed metadata and two texts; a text without any term is NULL."""
    groups = once(doc, lambda d: F.struct(_group_values(d, "scope_tag").alias("scope_tag"), _group_values(d, "place_keyword").alias("place_keyword")))
    routed = once(groups, lambda g: F.struct(scope_votes(g["scope_tag"]).alias("scope_tag"), route_values(g["place_keyword"]).alias("place_keyword")))
    texts = F.struct(scan(title).alias("title"), scan(abstract).alias("abstract"))
    return once(F.struct(routed.alias("r"), texts.alias("t")), lambda b: F.struct(b["r"]["scope_tag"].alias("scope_tag"), b["r"]["place_keyword"].alias("place_keyword"), b["t"]["title"].alias("title"), b["t"]["abstract"].alias("abstract")))


def _found(tier: int, vote: str, tokens: Column | None = None) -> Column:
    return F.struct(F.lit(tier).alias("tier"), F.lit(vote).alias("vote"), (F.lit("") if tokens is None else F.array_join(tokens, "; ")).alias("evidence"))


def _size(x: Column) -> Column:
    return F.coalesce(F.size(x), F.lit(0))


def scope_band(b: Column) -> Column:
    """Tier, vote and evidence of scope tags: one that means many countries decides, else any other does."""
    return F.when(_size(b["for"]) > 0, _found(3, "for", b["for"])).when(_size(b["against"]) > 0, _found(2, "against", b["against"])).otherwise(_found(0, "silent"))


def reliable_band(b: Column) -> Column:
    """Of place keywords, titles and place descriptions; a concrete term is the evidence where there are countries too."""
    return (
        F.when(_size(b["concrete"]) > 0, _found(3, "for", b["concrete"]))
        .when(_size(b["countries"]) > 1, _found(3, "for", b["countries"]))
        .when(_size(b["countries"]) == 1, _found(2, "against", b["countries"]))
        .when(_size(b["broad"]) > 0, _found(1, "for", b["broad"]))
        .otherwise(_found(0, "silent"))
    )


def abstract_band(b: Column) -> Column:
    """Of abstracts: a concrete term counts little, all else nothing."""
    return F.when(_size(b["concrete"]) > 0, _found(1, "for", b["concrete"])).otherwise(_found(0, "silent"))


def pooled(*bands: Column) -> Column:
    """The band of the highest tier, the first of equals."""
    out = bands[0]
    for b in bands[1:]:
        out = once(F.struct(out.alias("a"), b.alias("b")), lambda x: F.when(x["b"]["tier"] > x["a"]["tier"], x["b"]).otherwise(x["a"]))
    return out


def multi_country(rows: DataFrame, keep: list[str], terms: str = "terms", places: str = "spatial_desc", classification: str = "classification") -> DataFrame:
    """``keep`` and is_multi_country_eu, bbox_vote, spatial_desc_vote, terms_vote, agree, terms_evidence, text_tier, bbox_classification.

    ``terms`` is an ``evidence`` struct, ``places`` a comma-separated description, ``classification``
    the label of the box; any of them may be NULL. Evidence is that of the four bands alone.
    """
    bands = lambda t: pooled(scope_band(t["scope_tag"]), reliable_band(t["place_keyword"]), reliable_band(t["title"]), abstract_band(t["abstract"]))
    staged = rows.withColumn("__b", once(F.col(terms), bands))
    staged = staged.withColumn("__s", once(split_places(F.col(places)), reliable_band)).withColumn("__v", bbox_vote(F.col(classification)))
    tier = F.greatest(F.col("__b.tier"), F.col("__s.tier"))
    return staged.select(
        *keep, verdict(tier, F.col("__v")).alias("is_multi_country_eu"), F.col("__v").alias("bbox_vote"), F.col("__s.vote").alias("spatial_desc_vote"), F.col("__b.vote").alias("terms_vote"),
        agreement(F.col("__v"), F.col("__s.vote"), F.col("__b.vote")).alias("agree"), F.col("__b.evidence").alias("terms_evidence"), F.concat(F.lit("S"), tier.cast("string")).alias("text_tier"),
        F.col(classification).alias("bbox_classification"),
    )
