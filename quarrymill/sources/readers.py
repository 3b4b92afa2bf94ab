"""Readers of catalogue inputs as DataFrames: explicit schemas, no inference, no driver-side parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import clip_to_box, ring_points
from ..functions.places import COUNTRIES
from ..functions.text import cell


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 1, **options: str) -> DataFrame:
    """A database table; with ``key`` it is read in ``parts`` ranges of that column at once."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """source_label, target_label and pos (the place in the file) of a two-column CSV; an empty target stays empty."""
    rows = spark.read.csv(path, header=True, schema="source_label string, target_label string")
    return rows.select("source_label", F.coalesce("target_label", F.lit("")).alias("target_label"), F.monotonically_increasing_id().alias("pos"))


def subjects(spark: SparkSession, path: str) -> DataFrame:
    """id, uri and label of a CSV whose empty and NULL cells are missing."""
    rows = spark.read.csv(path, header=True, schema="id string, uri string, label string", quote='"', escape='"', multiLine=True)
    return rows.select(F.trim("id").cast("long").alias("id"), cell(F.col("uri")).alias("uri"), cell(F.col("label")).alias("label"))


CONCEPT = "identifier string, uris array<string>, labels map<string,array<string>>"


def concepts(spark: SparkSession, path: str) -> DataFrame:
    """Concepts of a JSON array file with the place of each, which decides ties."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"array<struct<{_fields(CONCEPT)}>>").alias("c"))
    return whole.select(F.posexplode("c").alias("pos", "c")).select("pos", "c.*")


def _fields(ddl: str) -> str:
    return ", ".join(f"{n}:{t}" for n, t in (x.split(" ", 1) for x in ddl.split(", ")))


def labelled(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """id, labels and text of JSON maps in several files; of an id in more than one, the last file by name counts."""
    rows = spark.read.text(paths, wholetext=True).select("_metadata.file_name", F.from_json("value", "map<string,struct<labels:array<string>,text:string>>").alias("m"))
    flat = rows.select("file_name", F.explode("m").alias("id", "v"))
    return flat.groupBy("id").agg(F.max_by("v", "file_name").alias("v")).select("id", "v.labels", "v.text")


def results(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All rows with a result of the NDJSON files that match a pattern."""
    return spark.read.schema(schema).json(pattern).where("res IS NOT NULL")


def geojson(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """name and rings (array of array of [lon, lat]) of a feature collection, holes and parts alike."""
    feature = f"properties:map<string,string>, geometry:struct<type:string, coordinates:string>"  # noqa: F541
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"features array<struct<{feature}>>")["features"]).alias("f"))
    poly = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.flatten(F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>"))
    return whole.select(F.col("f.properties")[name].alias("name"), F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(poly).alias("rings"))


# Names that the country file gives to countries of Europe, beside their short names in capitals.
FILE_NAMES = {
    "Bosnia & Herzegovina": "bosnia and herzegovina", "Czech Republic": "czechia", "Moldova, Republic of": "moldova", "Russian Federation": "russia",
    "The former Yugoslav Republic of Macedonia": "macedonia", "U.K. of Great Britain and Northern Ireland": "united kingdom",
}
# The country that is cut, and the box that is left of it.
CLIPPED, CLIP_BOX = "Russian Federation", (0.0, -90.0, 60.0, 90.0)


def countries(rows: DataFrame) -> DataFrame:
    """name, canonical, is_eu, rings and w, s, e, n of ``geojson`` rows: European by canonical name, one country cut at a meridian.

    Names stay those of the file; ``canonical`` is NULL for countries of other continents.
    """
    known = F.create_map(*[F.lit(x) for pair in FILE_NAMES.items() for x in pair])
    plain = F.when(F.lower("name").isin(COUNTRIES) & ~F.lower("name").isin("czechia", "russia", "united kingdom"), F.lower("name"))
    cut = F.transform("rings", lambda r: F.transform(clip_to_box(ring_points(r), *map(F.lit, CLIP_BOX)), lambda p: F.array(p["x"], p["y"])))
    rings = F.when(F.col("name") == CLIPPED, F.filter(cut, lambda r: F.size(r) > 2)).otherwise(F.col("rings"))
    out = rows.select("name", F.coalesce(F.try_element_at(known, F.col("name")), plain).alias("canonical"), rings.alias("rings"))
    return out.select("name", "canonical", F.col("canonical").isNotNull().alias("is_eu"), "rings", ring_bounds(F.col("rings")).alias("b")).select("name", "canonical", "is_eu", "rings", "b.*")


def ring_bounds(rings: Column) -> Column:
    """struct(w, s, e, n) of a geometry's rings."""
    points = F.flatten(rings)
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(x).alias("w"), F.array_min(y).alias("s"), F.array_max(x).alias("e"), F.array_max(y).alias("n"))


def xml_bbox(xml: Column) -> Column:
    """struct(w, s, e, n) of the first bounding box of an ISO 19139 record; NULL without one or where the XML is damaged."""
    sides = {"w": "westBoundLongitude", "s": "southBoundLatitude", "e": "eastBoundLongitude", "n": "northBoundLatitude"}
    # by pattern, not by XPath: a damaged record then gives NULL and doesn't end the job
    value = lambda tag: F.regexp_extract(xml, rf"(?s)<(?:\w+:)?{tag}\b[^>]*>\s*<[^>]*>\s*([-+0-9.eE]+)\s*<", 1).try_cast("double")
    found = F.struct(*[value(t).alias(c) for c, t in sides.items()])
    return F.when(found["w"].isNotNull() & found["s"].isNotNull() & found["e"].isNotNull() & found["n"].isNotNull(), found)


def triples(rows: DataFrame, key: str, turtle: str) -> DataFrame:
    """(key, s, p, o, kind, lang, pos): statements of N-Triples or Turtle with ``;`` and ``,`` lists.

    Prefixes and the base are resolved, ``a`` is the type. What can't be read (blank node lists,
    collections, damage) is skipped up to the end of its statement and returned as a row of kind
    ``unread`` with the skipped text as its object, so that nothing is lost without a word.
    """
    import pandas as pd

    kind = dict(rows.dtypes)[key]

    def parse(batches):
        for pdf in batches:
            out = []
            for k, text in zip(pdf[key], pdf[turtle], strict=True):
                out += [(k, *t, i) for i, t in enumerate(_statements(text or ""))]
            yield pd.DataFrame(out, columns=[key, "s", "p", "o", "kind", "lang", "pos"])

    return rows.select(key, turtle).mapInPandas(parse, f"`{key}` {kind}, s string, p string, o string, kind string, lang string, pos int")


# Fixed value: what ``a`` stands for.
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def _statements(text: str):
    import re

    token = re.compile(
        r"""\s*(?:(?P<comment>\#[^\n]*)|(?P<iri><[^<>\s]*>)|(?P<literal>\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|"(?:[^"\\\n]|\\.)*")(?:@(?P<lang>[A-Za-z-]+)|\^\^(?:<[^>]*>|[\w.-]*:[\w.-]+))?"""
        r"""|(?P<directive>@?(?i:prefix)\s+(?P<short>[\w.-]*):\s*<(?P<long>[^>]*)>(?:\s*\.)?|@?(?i:base)\s+<(?P<base>[^>]*)>(?:\s*\.)?)|(?P<mark>[;,.](?=\s|$))|(?P<name>[^\s;,<>"\[\]()]+?)(?=[\s;,]|\.\s|\.$|$))""",
        re.S,
    )
    prefixes: dict[str, str] = {}
    base, at, row = "", 0, []
    escapes = {"n": "\n", "t": "\t", "r": "\r"}

    def named(name: str, verb: bool) -> tuple[str, str, None]:
        short, colon, rest = name.partition(":")
        if verb and name == "a":
            return TYPE, "iri", None
        return (prefixes[short] + rest, "iri", None) if colon and short in prefixes else (name, "name", None)

    while text[at:].strip():
        m = token.match(text, at)
        if not m or m.end() == at or len(row) == 3 and not m["mark"] and not m["comment"]:
            stop = re.compile(r"\.(?:\s+|$)").search(text, at)
            end = stop.end() if stop else len(text)
            yield None, None, text[at:end].strip(), "unread", None
            at, row = end, []
            continue
        at = m.end()
        if m["directive"]:
            if m["long"] is not None:
                prefixes[m["short"]] = m["long"]
            else:
                base = m["base"]
        elif m["mark"]:
            row = {".": [], ";": row[:1], ",": row[:2]}[m["mark"]]
        elif m["iri"] is not None:
            iri = m["iri"][1:-1]
            row.append((iri if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", iri) else base + iri, "iri", None))
        elif m["literal"] is not None:
            bare = m["literal"][3:-3] if m["literal"].startswith('"""') else m["literal"][1:-1]
            row.append((re.sub(r"\\(.)", lambda x: escapes.get(x[1], x[1]), bare), "literal", m["lang"]))
        elif m["name"]:
            row.append(named(m["name"], len(row) == 1))
        if len(row) == 3 and not m["comment"]:
            (s, _, _), (p, _, _), (o, kind, lang) = row
            yield s, p, o, kind, lang
