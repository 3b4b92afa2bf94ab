"""What comes from outside, by way of cache tables (key, status, body): a hit is projected, a miss is a pending row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve(rows: DataFrame, key: str, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with status and body where the cache has their key, and the distinct keys that it lacks."""
    table = cache.select(F.col("key").alias("__key"), "status", "body")
    found = rows.join(table, F.col(key) == F.col("__key")).drop("__key")
    missing = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct().join(cache, "key", "left_anti")
    return found, missing


def crossref(body: Column) -> Column:
    """struct of title, type, publisher, issued, references (DOIs) and n_cited of a works answer; NULL for other text."""
    ref = "map<string,string>"  # its keys differ in case only
    shape = f"message struct<title:array<string>, type:string, publisher:string, issued:struct<`date-parts`:array<array<int>>>, reference:array<{ref}>, `is-referenced-by-count`:long>"
    m = F.from_json(body, shape)["message"]
    dois = F.transform(F.coalesce(m["reference"], F.array().cast(f"array<{ref}>")), lambda r: F.trim(F.coalesce(F.try_element_at(r, F.lit("DOI")), F.try_element_at(r, F.lit("doi")))))
    unique = F.array_distinct(F.filter(dois, lambda d: d.isNotNull() & (d != "")))
    parts = F.get(m["issued"]["date-parts"], 0)
    return F.when(m.isNotNull(), F.struct(F.get(m["title"], 0).alias("title"), m["type"].alias("type"), m["publisher"].alias("publisher"), F.array_join(F.transform(parts, lambda p: F.when(p < 10, F.concat(F.lit("0"), p.cast("string"))).otherwise(p.cast("string"))), "-").alias("issued"), unique.alias("references"), m["is-referenced-by-count"].alias("n_cited")))


def organisation(body: Column) -> Column:
    """struct(ror, name, city, country) of the first item of a registry answer."""
    shape = "items array<struct<id:string, name:string, addresses:array<struct<city:string>>, country:struct<country_name:string>>>"
    first = F.get(F.from_json(body, shape)["items"], 0)
    return F.when(first.isNotNull(), F.struct(first["id"].alias("ror"), first["name"].alias("name"), F.get(first["addresses"], 0)["city"].alias("city"), first["country"]["country_name"].alias("country")))


def geocoded(records: DataFrame, key: str, names: str, cache: DataFrame) -> DataFrame:
    """(key, w, s, e, n): the union of the boxes of a record's comma-separated names; records with none found are left out.

    A cached body is a list of candidates with ``boundingbox`` (south, north, west, east) as text; the first counts.
    """
    flat = records.select(key, F.explode(F.split(names, ",")).alias("name")).select(key, F.lower(F.trim("name")).alias("name")).where("name <> ''")
    box = F.get(F.from_json("body", "array<struct<boundingbox:array<string>>>"), 0)["boundingbox"]
    known = cache.where("status = 200").select(F.lower("key").alias("name"), box.alias("b")).where("size(b) = 4")
    at = lambda k: F.get("b", k).try_cast("double")
    rows = flat.join(known, "name").select(key, at(2).alias("w"), F.least(at(0), at(1)).alias("s"), at(3).alias("e"), F.greatest(at(0), at(1)).alias("n"))
    return rows.groupBy(key).agg(F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))


def video(body: Column) -> Column:
    """struct(name, description, published, keywords, parts) of a video or playlist answer."""
    snippet = "snippet:struct<title:string, description:string, publishedAt:string, tags:array<string>, resourceId:struct<videoId:string>>"
    items = F.from_json(body, f"items array<struct<{snippet}>>")["items"]
    first = F.get(items, 0)["snippet"]
    parts = F.filter(F.transform(items, lambda i: i["snippet"]["resourceId"]["videoId"]), lambda v: v.isNotNull())
    return F.when(first.isNotNull(), F.struct(first["title"].alias("name"), first["description"].alias("description"), first["publishedAt"].alias("published"), first["tags"].alias("keywords"), parts.alias("parts")))
