"""Queries of the box, country and evidence operators, over boxes and countries made from the driver's keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo as G
from .operators import spatial as S
from .registry import query, spread, table

BOXES = """
boxes AS (SELECT c_custkey AS id, CAST((c_custkey * 37) % 340 - 170 AS DOUBLE) AS w, CAST((c_custkey * 23) % 160 - 80 AS DOUBLE) AS s,
  CAST((c_custkey * 37) % 340 - 169 + (c_custkey * 7) % 20 AS DOUBLE) AS e, CAST((c_custkey * 23) % 160 - 79 + (c_custkey * 5) % 10 AS DOUBLE) AS n FROM customer)"""
COUNTRIES = """
countries AS (SELECT n_name AS name, n_nationkey % 3 <> 0 AS is_eu, CAST((n_nationkey * 29) % 70 - 30 AS DOUBLE) AS w, CAST((n_nationkey * 17) % 40 + 30 AS DOUBLE) AS s,
  CAST((n_nationkey * 29) % 70 - 25 + (n_nationkey % 4) * 4 AS DOUBLE) AS e, CAST((n_nationkey * 17) % 40 + 34 + (n_nationkey % 3) * 3 AS DOUBLE) AS n FROM nation)"""


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    w, s = (k * 37) % 340 - 170, (k * 23) % 160 - 80
    cols = {"w": w, "s": s, "e": w + 1 + (k * 7) % 20, "n": s + 1 + (k * 5) % 10}
    return table(spark, sf, "customer").select(k.alias("id"), *[c.cast("double").alias(n) for n, c in cols.items()])


def countries(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    w, s = (k * 29) % 70 - 30, (k * 17) % 40 + 30
    cols = {"w": w, "s": s, "e": w + 5 + (k % 4) * 4, "n": s + 4 + (k % 3) * 3}
    return table(spark, sf, "nation").select(F.col("n_name").alias("name"), (k % 3 != 0).alias("is_eu"), *[c.cast("double").alias(n) for n, c in cols.items()])


def valid(rows: DataFrame) -> DataFrame:
    return rows.where(G.is_wgs84({c: F.col(c) for c in "wsen"}))


VALID = "w BETWEEN -180 AND 180 AND e BETWEEN -180 AND 180 AND s BETWEEN -90 AND 90 AND n BETWEEN -90 AND 90 AND e >= w AND n >= s"


@query(f"""
WITH {BOXES} SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE w END AS w, CASE WHEN id % 11 = 0 THEN NULL ELSE n END AS n,
  id % 11 <> 0 AND ({VALID}) AS ok FROM boxes
""")
def bbox_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("("), F.concat_ws(", ", *[F.col(c).cast("string") for c in "wsen"]), F.lit(")"))
    text = F.when(F.col("id") % 22 == 0, "[1, 2, 3]").when(F.col("id") % 11 == 0, "[1, 2, 3, x]").otherwise(text)
    b = boxes(spark, sf).select("id", G.parse_bbox(text).alias("b"))
    return b.select("id", "b.w", "b.n", G.is_wgs84(F.col("b")).alias("ok"))


HITS = f"""
WITH {BOXES}, {COUNTRIES}, good AS (SELECT * FROM boxes WHERE {VALID}),
hits AS (SELECT b.id, c.name, c.is_eu, greatest(least(b.e, c.e) - greatest(b.w, c.w), 0) * greatest(least(b.n, c.n) - greatest(b.s, c.s), 0) AS area,
  (c.e - c.w) * (c.n - c.s) AS country_area FROM good b JOIN countries c ON b.e >= c.w AND b.w <= c.e AND b.n >= c.s AND b.s <= c.n)
"""


@query(f"{HITS} SELECT id, name, is_eu, area, round(area / country_area, 6) AS coverage FROM hits")
def bbox_country_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return S.box_hits(valid(boxes(spark, sf)), countries(spark, sf)).select("id", "name", "is_eu", "area", F.round("coverage", 6).alias("coverage"))


CLASSES = f"""{HITS},
eu AS (SELECT *, area / country_area AS coverage, round(area / sum(area) OVER (PARTITION BY id), 4) AS share, row_number() OVER (PARTITION BY id ORDER BY area DESC, name) AS ra,
  row_number() OVER (PARTITION BY id ORDER BY area / country_area DESC, name) AS rc FROM hits WHERE is_eu AND area > 0),
agg AS (SELECT id, count(*) AS n_eu, max(CASE WHEN ra = 1 THEN name END) AS top, max(CASE WHEN ra = 1 THEN share END) AS top_share,
  round(max(CASE WHEN ra = 1 THEN area END) / max(CASE WHEN ra = 2 THEN area END), 4) AS ratio, max(CASE WHEN rc = 1 THEN name END) AS coverage_top, max(CASE WHEN rc = 1 THEN share END) AS coverage_share,
  round(max(CASE WHEN rc = 1 THEN coverage END) / max(CASE WHEN rc = 2 THEN coverage END), 4) AS coverage_ratio,
  sum(CASE WHEN coverage >= 0.5 THEN area ELSE 0 END) AS meaningful, sum(area) AS total FROM eu GROUP BY id),
other AS (SELECT DISTINCT id FROM hits WHERE NOT is_eu AND area > 0),
raw AS (SELECT g.id, n_eu > 1 AND NOT (coalesce(ratio, 0) > 2 OR top_share >= 0.5) AS last, CASE WHEN n_eu IS NULL THEN 'non_european' WHEN o.id IS NOT NULL AND NOT (meaningful > 0 AND meaningful / total >= 0.1) THEN 'non_european' WHEN n_eu = 1 THEN 'single_country_eu'
  WHEN coalesce(ratio, 0) > 2 OR top_share >= 0.5 THEN 'single_country_eu' WHEN coalesce(coverage_ratio > 1.5 AND coverage_share > 0.1, FALSE) THEN 'single_country_eu' ELSE 'multi_country_eu' END AS classification,
  top, top_share, ratio, coverage_ratio, coverage_top FROM good g LEFT JOIN agg a USING (id) LEFT JOIN other o ON o.id = g.id),
classes AS (SELECT id, classification, CASE WHEN told THEN top END AS top, CASE WHEN told THEN top_share END AS top_share, CASE WHEN told THEN ratio END AS ratio,
  CASE WHEN told AND last THEN coverage_ratio END AS coverage_ratio, CASE WHEN told AND last THEN coverage_top END AS coverage_top FROM (SELECT *, classification <> 'non_european' AS told FROM raw))
"""


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return S.classify(valid(boxes(spark, sf)), countries(spark, sf), "id")


@query(f"{CLASSES} SELECT id, classification, top, top_share, ratio, coverage_ratio, coverage_top FROM classes")
def bbox_classification(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf)


@query(f"""{CLASSES},
ev AS (SELECT *, id % 4 AS concrete0, id % 5 AS countries0, id % 3 AS broad0, CASE classification WHEN 'multi_country_eu' THEN 'for' ELSE 'against' END AS bbox_vote FROM classes),
a AS (SELECT *, CASE WHEN concrete0 = 3 OR countries0 >= 3 THEN 3 WHEN countries0 = 2 THEN 2 WHEN broad0 > 0 THEN 1 ELSE 0 END AS t1,
  CASE WHEN id % 7 = 0 THEN 3 WHEN id % 7 = 1 THEN 2 ELSE 0 END AS t2 FROM ev),
b AS (SELECT *, greatest(t1, t2) AS tier, CASE WHEN greatest(t1, t2) = 0 THEN 'silent' WHEN greatest(t1, t2) = 2 THEN 'against' ELSE 'for' END AS terms_vote FROM a)
SELECT id, tier AS text_tier, bbox_vote, terms_vote,
  CASE tier WHEN 3 THEN TRUE WHEN 2 THEN FALSE WHEN 1 THEN bbox_vote <> 'against' ELSE bbox_vote = 'for' END AS is_multi_country_eu,
  CASE WHEN terms_vote = 'silent' THEN '' WHEN terms_vote = bbox_vote THEN 'agree' ELSE 'disagree' END AS agree FROM b
""")
def multi_country_verdict(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("id")
    rows = classified(spark, sf).withColumn("bbox_vote", S.bbox_vote(F.col("classification")))
    first = S.band((k % 4 == 3).cast("int"), k % 3, F.greatest(k % 5 - 1, F.lit(0)))
    tag = S.band((k % 7 == 0).cast("int"), F.lit(0), (k % 7 == 1).cast("int"))
    rows = rows.withColumn("p", S.pooled(first, tag))
    vote = F.col("p.vote")
    return rows.select(
        "id", F.col("p.tier").alias("text_tier"), "bbox_vote", vote.alias("terms_vote"),
        S.verdict(F.col("p.tier"), F.col("bbox_vote")).alias("is_multi_country_eu"), S.agreement(F.col("bbox_vote"), vote).alias("agree"),
    )


def _laea_sql(x: str, y: str) -> tuple[str, str]:
    import math

    q = f"({1 - G.E2!r} * (sin(radians({y})) / (1 - {G.E2!r} * sin(radians({y})) * sin(radians({y}))) - ln((1 - {G.E1!r} * sin(radians({y}))) / (1 + {G.E1!r} * sin(radians({y})))) / {2 * G.E1!r}))"
    beta = f"asin(greatest(least({q} / {G.QP!r}, 1.0), -1.0))"
    sb, cb = math.sin(G.BETA0), math.cos(G.BETA0)
    b = f"({G.RQ!r} * sqrt(2.0 / (1 + {sb!r} * sin({beta}) + {cb!r} * cos({beta}) * cos(radians({x}) - {G.LON0!r}))))"
    return f"({G.EAST0!r} + {b} * {G.D!r} * cos({beta}) * sin(radians({x}) - {G.LON0!r}))", f"({G.NORTH0!r} + {b} / {G.D!r} * ({cb!r} * sin({beta}) - {sb!r} * cos({beta}) * cos(radians({x}) - {G.LON0!r})))"


_C = [_laea_sql(x, y) for x, y in (("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"))]
_TWICE = " + ".join(f"({a[0]} * {b[1]} - {b[0]} * {a[1]})" for a, b in zip(_C, _C[1:] + _C[:1], strict=True))


@query(f"""
WITH {COUNTRIES} SELECT name, round(abs({_TWICE}) / 2e6, 0) AS km2, round({_C[0][0]}, 1) AS east, round({_C[0][1]}, 1) AS north FROM countries
""")
def projected_area(spark: SparkSession, sf: str) -> DataFrame:
    c = {k: F.col(k) for k in "wsen"}
    east, north = G.laea(c["w"], c["s"])
    return countries(spark, sf).select("name", F.round(G.bbox_km2(*[c[k] for k in "wsen"]), 0).alias("km2"), F.round(east, 1).alias("east"), F.round(north, 1).alias("north"))


@query(f"""
WITH {BOXES} SELECT id, CASE WHEN id % 10 = 0 THEN 'skipped' WHEN (e - w) * (n - s) >= (id % 90) - (id % 90) / 7.5 THEN 'national' ELSE 'regional' END AS scope FROM boxes
""")
def national_or_regional(spark: SparkSession, sf: str) -> DataFrame:
    country = F.when(F.col("id") % 10 != 0, (F.col("id") % 90).cast("double"))
    return boxes(spark, sf).select("id", S.national((F.col("e") - F.col("w")) * (F.col("n") - F.col("s")), country).alias("scope"))


@query(f"""
{HITS}, cen AS (SELECT b.id, min(c.name) AS name FROM good b JOIN countries c ON (b.w + b.e) / 2 BETWEEN c.w AND c.e AND (b.s + b.n) / 2 BETWEEN c.s AND c.n GROUP BY b.id),
most AS (SELECT id, name FROM (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY area DESC, name) AS k FROM hits WHERE area > 0) WHERE k = 1)
SELECT g.id, coalesce(cen.name, most.name) AS country FROM good g LEFT JOIN cen USING (id) LEFT JOIN most USING (id)
""")
def country_of_box(spark: SparkSession, sf: str) -> DataFrame:
    rows, land = valid(boxes(spark, sf)), countries(spark, sf)
    x, y = (F.col("w") + F.col("e")) / 2, (F.col("s") + F.col("n")) / 2
    centres = rows.select("id", x.alias("w"), y.alias("s"), x.alias("e"), y.alias("n"))
    cen = S.box_hits(centres, land).groupBy("id").agg(F.min("name").alias("cen"))
    most = S.box_hits(rows, land).where("area > 0").groupBy("id").agg(F.min_by("name", F.struct(-F.col("area"), F.col("name"))).alias("most"))
    return rows.select("id").join(cen, "id", "left").join(most, "id", "left").select("id", F.coalesce("cen", "most").alias("country"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, event_id % 3 <> 0 AS open_data, event_id % 2 = 0 AS soil FROM events
""")
def metadata_keywords(spark: SparkSession, sf: str) -> DataFrame:
    from .operators import documents as D

    k = F.get_json_object("props", "$.k")
    group = F.when(F.col("event_id") % 3 == 1, "Open-Data").when(F.col("event_id") % 3 == 2, "open_ data x").otherwise("closed")
    second = F.when(F.col("event_id") % 2 == 0, "Topsoil").otherwise("water")
    doc = F.to_json(F.struct(F.struct(F.struct(F.struct(F.array(group, second).alias("keywords")).alias("g")).alias("keywords"), k.alias("rights")).alias("identification")))
    rows = table(spark, sf, "events").select("event_id", D.parse(doc).alias("m"))
    return rows.select("event_id", F.col("m.identification.rights").alias("k"), D.is_open_data(D.keywords(F.col("m"))).alias("open_data"), D.mentions(F.lit("t"), F.lit(None).cast("string"), D.keywords(F.col("m")), "soil").alias("soil"))


_EUROPE = "['FRANCE', 'GERMANY', 'ROMANIA', 'RUSSIA', 'UNITED KINGDOM']"


@query(f"""
WITH i AS (SELECT c_custkey AS id, lower(a.n_name) AS n1, lower(b.n_name) AS n2, c_mktsegment AS seg, lower(trim(CASE c_custkey % 6 WHEN 0 THEN 'EEA39' WHEN 1 THEN ' Europe ' WHEN 2 THEN 'National' WHEN 3 THEN 'European' ELSE 'Atlantis' END)) AS extra,
  list_transform({_EUROPE}, lambda v: lower(v)) AS eu, CASE c_custkey % 5 WHEN 0 THEN 'multi_country_eu' WHEN 1 THEN 'single_country_eu' WHEN 2 THEN 'non_european' WHEN 3 THEN 'invalid' END AS label,
  c_custkey % 4 = 0 AS warm FROM customer JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON b.n_nationkey = c_custkey % 25),
k AS (SELECT *, list_distinct([n1, n2, extra]) AS kw, list_sort(list_distinct(list_filter([n1, n2], lambda v: list_contains(eu, v)))) AS places, list_contains(eu, n1) AS titled, list_contains(eu, n2) AS described FROM i),
b AS (SELECT *, seg = 'AUTOMOBILE' AS scope, seg IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD') AS placed, extra = 'european' AS wide, extra = 'eea39' AS concrete, extra IN ('europe', 'european') AS broad FROM k),
p AS (SELECT *, CASE WHEN scope THEN CASE WHEN wide THEN 3 ELSE 2 END WHEN placed THEN CASE WHEN concrete OR len(places) > 1 THEN 3 WHEN len(places) = 1 THEN 2 WHEN broad THEN 1 ELSE 0 END ELSE 0 END AS t1,
  CASE WHEN scope AND wide THEN 'european' WHEN scope THEN array_to_string(list_filter([n1, n2, extra], lambda v, i: list_position([n1, n2, extra], v) = i), '; ')
    WHEN NOT placed THEN '' WHEN concrete THEN 'eea39' WHEN len(places) > 0 THEN array_to_string(places, '; ') WHEN broad THEN extra ELSE '' END AS e1,
  CASE WHEN titled THEN 2 WHEN NOT warm THEN 1 ELSE 0 END AS t2, CASE WHEN titled THEN n1 WHEN NOT warm THEN 'global' ELSE '' END AS e2,
  CASE WHEN concrete THEN 1 ELSE 0 END AS t3, CASE WHEN concrete THEN 3 WHEN described THEN 2 WHEN broad THEN 1 ELSE 0 END AS ts FROM b),
q AS (SELECT *, greatest(t1, t2, t3) AS tt, CASE WHEN t1 >= greatest(t2, t3) THEN e1 WHEN t2 >= t3 THEN e2 ELSE 'eea39' END AS evidence FROM p),
v AS (SELECT *, greatest(tt, ts) AS tier, CASE tt WHEN 0 THEN 'silent' WHEN 2 THEN 'against' ELSE 'for' END AS tv, CASE ts WHEN 0 THEN 'silent' WHEN 2 THEN 'against' ELSE 'for' END AS sv,
  CASE WHEN label = 'multi_country_eu' THEN 'for' WHEN label IN ('single_country_eu', 'non_european') THEN 'against' ELSE 'silent' END AS bv FROM q),
w AS (SELECT *, list_filter([bv, sv, tv], lambda x: x <> 'silent') AS said FROM v)
SELECT id, CASE tier WHEN 3 THEN TRUE WHEN 2 THEN FALSE WHEN 1 THEN bv <> 'against' ELSE bv = 'for' END AS is_multi_country_eu, bv AS bbox_vote, sv AS spatial_desc_vote, tv AS terms_vote,
  CASE WHEN len(said) < 2 THEN '' WHEN len(list_distinct(said)) = 1 THEN 'agree' ELSE 'disagree' END AS agree, evidence AS terms_evidence, 'S' || tier AS text_tier, label AS bbox_classification FROM w
""")
def multi_country_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Records of metadata, texts, place descriptions and box labels made from customers and nations, through parsing, bands and votes."""
    from .operators import coverage, documents

    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")  # 25 rows
    first, second = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("n1")), nation.select(F.col("n_nationkey").alias("other"), F.col("n_name").alias("n2"))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment", (F.col("c_custkey") % 25).cast("int").alias("other"))
    rows = spread(rows, "id").join(F.broadcast(first), "c_nationkey").join(F.broadcast(second), "other")
    k = F.col("id") % 6
    extra = F.when(k == 0, "EEA39").when(k == 1, " Europe ").when(k == 2, "National").when(k == 3, "European").otherwise("Atlantis")
    vocabulary = F.create_map(*[F.lit(x) for x in ("AUTOMOBILE", "Spatial scope", "BUILDING", " Country", "FURNITURE", "Region", "MACHINERY", "GEMET", "HOUSEHOLD", "none")])
    kind = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Place").otherwise("theme")
    group = F.struct(kind.alias("keywords_type"), F.struct(F.element_at(vocabulary, F.col("c_mktsegment")).alias("name")).alias("vocabulary"), F.array("n1", "n2", extra).alias("keywords"))
    text = F.to_json(F.struct(F.struct(F.create_map(F.lit("g"), group).alias("keywords")).alias("identification")))
    title = F.concat(F.lit("Soils of "), F.initcap("n1"), F.when(F.col("id") % 4 == 0, " under global warming").otherwise(", a global map"))
    abstract = F.concat_ws(" ", F.lit("Europe and"), "n2", F.when(k == 0, "in EEA39."))
    five = F.col("id") % 5
    label = F.when(five == 0, "multi_country_eu").when(five == 1, "single_country_eu").when(five == 2, "non_european").when(five == 3, "invalid")
    rows = rows.select("id", coverage.evidence(documents.parse(text), title, abstract).alias("terms"), F.concat_ws(",", "n2", extra).alias("spatial_desc"), label.alias("classification"))
    return coverage.multi_country(rows, ["id"])
