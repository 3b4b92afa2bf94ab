"""Boxes against countries, the classification ladder, and the fusion of evidence into a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geo import covers, overlap_degrees, overlap_km2, overlaps, shape

#: Degrees of a grid cell that turns the overlap join into an equi-join.
CELL = 15

# Thresholds of the classification ladder.
RATIO, SHARE, COVERAGE_RATIO, COVERAGE_SHARE = 2.0, 0.5, 1.5, 0.1
MEANINGFUL, RELEVANT = 0.5, 0.1


def cells(w: Column, s: Column, e: Column, n: Column, step: int = CELL) -> Column:
    """The grid cells that a box touches."""
    axis = lambda a, b: F.sequence(F.floor(a / step).cast("int"), F.floor(b / step).cast("int"))
    return F.flatten(F.transform(axis(w, e), lambda x: F.transform(axis(s, n), lambda y: x * 1000 + y)))


def box_hits(boxes: DataFrame, countries: DataFrame) -> DataFrame:
    """Each box with every country whose bounds it touches: box columns, name, is_eu, area, country_area, coverage.

    The area of a line is the length inside, and that of a point 1. With a column ``rings`` the
    countries are polygons: areas are those that box and polygon share in the projection, in
    square kilometres, a point counts where it lies inside, and bounds only choose the candidates.

    Both sides are dealt to grid cells and joined by cell; a pair counts in the first cell that
    both share only, so no duplicate has to be removed by a shuffle.
    """
    left = boxes.withColumn("__cell", F.explode(cells(F.col("w"), F.col("s"), F.col("e"), F.col("n"))))
    exact = ["rings"] if "rings" in countries.columns else []
    right = countries.select("name", "is_eu", *exact, *[F.col(c).alias(f"c{c}") for c in "wsen"]).withColumn("__cell", F.explode(cells(F.col("cw"), F.col("cs"), F.col("ce"), F.col("cn"))))
    a, b = {c: F.col(c) for c in "wsen"}, {c: F.col(f"c{c}") for c in "wsen"}
    first = F.floor(F.greatest("w", "cw") / CELL).cast("int") * 1000 + F.floor(F.greatest("s", "cs") / CELL).cast("int")
    pairs = left.join(right, "__cell").where(overlaps(a, b) & (F.col("__cell") == first))
    country = (F.col("ce") - F.col("cw")) * (F.col("cn") - F.col("cs"))
    both = [F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]) for lo, hi in (("w", "e"), ("s", "n"))]
    kind = shape(a)
    box, one = overlap_degrees(a, b), F.lit(1.0)
    if exact:
        rings = F.col("rings")
        one = F.when(covers(rings, a["w"], a["s"]), 1.0).otherwise(0.0)
        box = overlap_km2(rings, *[F.greatest(a[c], b[c]) for c in "ws"], *[F.least(a[c], b[c]) for c in "en"])
        country = overlap_km2(rings, *[b[c] for c in "wsen"])
    size = F.when(kind == "point", one).when(kind == "line", F.greatest(*both)).otherwise(box)
    out = pairs.withColumn("area", size).withColumn("country_area", country).drop(*exact)
    return out.withColumn("coverage", F.col("area") / F.col("country_area")).drop("__cell", *[f"c{c}" for c in "wsen"])


def dominance(hits: DataFrame, by: str) -> DataFrame:
    """Per box: leading country, its share, its lead over the next (ratio), and the same by coverage."""
    w = Window.partitionBy(by)
    area, cover = w.orderBy(F.desc("area"), "name"), w.orderBy(F.desc("coverage"), "name")
    x = hits.withColumn("share", F.round(F.col("area") / F.sum("area").over(w), 4)).withColumn("__a", F.row_number().over(area)).withColumn("__c", F.row_number().over(cover))
    pick = lambda col, rank, k: F.max(F.when(F.col(rank) == k, F.col(col)))
    out = x.groupBy(by).agg(
        pick("name", "__a", 1).alias("top"), pick("share", "__a", 1).alias("top_share"), pick("area", "__a", 1).alias("a1"), pick("area", "__a", 2).alias("a2"),
        pick("name", "__c", 1).alias("coverage_top"), pick("share", "__c", 1).alias("coverage_share"), pick("coverage", "__c", 1).alias("c1"), pick("coverage", "__c", 2).alias("c2"),
        F.count(F.lit(1)).alias("n_eu"), F.sum("area").alias("total"), F.sum(F.when(F.col("coverage") >= MEANINGFUL, F.col("area")).otherwise(0.0)).alias("meaningful"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 4))
    return out.withColumn("ratio", ratio("a1", "a2")).withColumn("coverage_ratio", ratio("c1", "c2")).drop("a1", "a2", "c1", "c2")


def classify(boxes: DataFrame, countries: DataFrame, by: str, giant: str | None = None) -> DataFrame:
    """Each valid box as single_country_eu, multi_country_eu or non_european, with the figures behind it.

    Points go by the countries that cover them and lines by length alone; neither looks at
    others than EU countries. A box of which ``giant`` has the most, but under half, isn't about it.
    """
    kind = shape({c: F.col(c) for c in "wsen"})
    hits = box_hits(boxes, countries).where("area > 0")
    eu = dominance(hits.where("is_eu"), by)
    other = hits.where("NOT is_eu").select(by).distinct().withColumn("has_other", F.lit(True))
    rows = boxes.withColumn("kind", kind).join(eu, by, "left").join(other, by, "left").withColumn("has_other", F.coalesce("has_other", F.lit(False)))
    polygon, yes = F.col("kind") == "polygon", lambda c: F.coalesce(c, F.lit(False))
    irrelevant = polygon & F.col("has_other") & ~yes((F.col("meaningful") > 0) & (F.col("meaningful") / F.col("total") >= RELEVANT))
    shy = yes((F.col("top") == F.lit(giant)) & (F.col("top_share") < SHARE))
    lead = yes(F.col("ratio") > RATIO) | polygon & (F.col("top_share") >= SHARE)
    cover = yes((F.col("coverage_ratio") > COVERAGE_RATIO) & (F.col("coverage_share") > COVERAGE_SHARE))
    label = (
        F.when(F.col("n_eu").isNull() | irrelevant, "non_european")
        .when(F.col("n_eu") == 1, "single_country_eu")
        .when((F.col("kind") == "point") | shy, "multi_country_eu")
        .when(lead, "single_country_eu")
        .when(polygon & cover, "single_country_eu")
        .otherwise("multi_country_eu")
    )
    last = polygon & (F.col("n_eu") > 1) & ~irrelevant & ~shy & ~lead  # the coverage decides, or nothing does
    out = rows.select(by, label.alias("classification"), "top", "top_share", F.when(F.col("kind") != "point", F.col("ratio")).alias("ratio"), *[F.when(last, F.col(c)).alias(c) for c in ("coverage_ratio", "coverage_top")])
    told = F.col("classification") != "non_european"
    return out.select(by, "classification", *[F.when(told, F.col(c)).alias(c) for c in ("top", "top_share", "ratio", "coverage_ratio", "coverage_top")])


def shares(hits: DataFrame, by: str) -> DataFrame:
    """(by, countries): map of each box's EU countries to their share of what it covers of them."""
    w = Window.partitionBy(by)
    rows = hits.where("is_eu AND area > 0").withColumn("share", F.round(F.col("area") / F.sum("area").over(w), 4))
    return rows.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "share")))).alias("countries"))


def bbox_vote(classification: Column) -> Column:
    return F.when(classification == "multi_country_eu", "for").when(classification.isin("single_country_eu", "non_european"), "against").otherwise("silent")


def band(concrete: Column, broad: Column, countries: Column) -> Column:
    """Tier and vote of a band of reliable terms, from how many of each kind it holds."""
    pair = lambda tier, vote: F.struct(F.lit(tier).alias("tier"), F.lit(vote).alias("vote"))
    return F.when((concrete > 0) | (countries >= 2), pair(3, "for")).when(countries == 1, pair(2, "against")).when(broad > 0, pair(1, "for")).otherwise(pair(0, "silent"))


def pooled(*bands: Column) -> Column:
    """The band of the highest tier; the first one on ties."""
    ranked = F.array(*[F.struct(b["tier"].alias("tier"), F.lit(-k).alias("pos"), b["vote"].alias("vote")) for k, b in enumerate(bands)])
    return F.array_max(ranked)


def verdict(tier: Column, vote: Column) -> Column:
    """Tier 3 says yes, tier 2 no, tier 1 yes unless the box is against, tier 0 what the box says."""
    return F.when(tier == 3, True).when(tier == 2, False).when(tier == 1, vote != "against").otherwise(vote == "for")


def agreement(*votes: Column) -> Column:
    """Whether the votes that aren't silent are alike; empty where fewer than two are."""
    said = F.filter(F.array(*votes), lambda v: v != "silent")
    return F.when(F.size(said) < 2, "").when(F.size(F.array_distinct(said)) == 1, "agree").otherwise("disagree")


def national(area: Column, country: Column, part: float = 7.5) -> Column:
    """Whether a box covers a country within its tolerance; ``skipped`` without a known area."""
    return F.when(country.isNull(), "skipped").when(area >= country - country / part, "national").otherwise("regional")
