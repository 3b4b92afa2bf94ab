"""End-to-end augmenters: each one declarative plan from pending records to augment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import downloads as D
from ..functions import identifiers as I  # noqa: E741
from ..functions.text import label_key, present
from ..operators import ledger as L
from ..operators import matching as M


def elements(records: DataFrame, done: DataFrame, mappings: dict[str, DataFrame], as_of: Column, process: str = "elements") -> DataFrame:
    """Each pending record's type, language and so on as its mapping says; a row for every record and property, mapped or not."""
    rows = L.not_in(records, "identifier", done.where(F.col("process").ilike(process)), "record_id").dropDuplicates(["identifier"])
    for name, table in mappings.items():
        rows = M.dictionary(rows, name, table, f"mapped_{name}")
    return L.augment(rows, "identifier", {n: F.col(f"mapped_{n}") for n in mappings}, process, as_of)


def keywords(subjects: DataFrame, concepts: DataFrame, least: int = 80, fallthrough: bool = True) -> DataFrame:
    """(subject, concept, method) by address, then label, then fuzzy label. Subjects with neither are left out.

    Without ``fallthrough`` a subject with an address is matched by it only.
    """
    some = subjects.where(present(F.col("uri")) | present(F.col("label"))).withColumn("key", F.lower(label_key(F.col("label"))))
    uris = concepts.select(F.col("identifier").alias("concept"), "pos", F.explode("uris").alias("uri"))
    by_uri = some.select(F.col("id").alias("subject"), "uri").join(uris, "uri").groupBy("subject").agg(F.min_by("concept", "pos").alias("concept"))
    rest = some if fallthrough else some.where(~present(F.col("uri")))
    flat = concepts.select(F.col("identifier").alias("concept"), "pos", F.explode(F.flatten(F.map_values("labels"))).alias("label"))
    by_label = M.exact(rest, flat, "id", F.col("key"))
    best = M.best_label(M.fuzzy_scores(rest, flat.withColumn("label", F.lower("label")), least), ["key"])
    fuzzy = rest.select(F.col("id").alias("subject"), "key").join(best, "key").select("subject", "concept")
    return M.cascade(some, [("url_match", by_uri), ("exact_match", by_label), ("fuzzy", fuzzy)], "id")


def files(records: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of records with a DOI: (record_id, file_url) by their landing page, and (record_id, status), ``pending`` where the cache (doi, status, url, body) lacks the DOI."""
    pages = records.withColumn("doi", I.doi_of(F.col("identifier"))).where("doi IS NOT NULL").select(F.col("identifier").alias("record_id"), "doi").join(cache, "doi", "left")
    found = I.page_links(F.coalesce("body", F.lit("")), ["download", "bitstream", ".pdf", ".zip", ".csv"])
    joined = F.transform(found, lambda x: I.join_url(F.col("url"), x))
    links = F.array_distinct(F.concat(D.files_of(F.coalesce("url", F.lit(""))), joined))
    code = F.when(F.col("status").isNull(), "pending").when(F.col("status") == 200, "success").otherwise("error")
    return pages.where("status = 200").select("record_id", F.explode(links).alias("file_url")), pages.select("record_id", code.alias("status"))


def translation_requests(records: DataFrame, queue: DataFrame, as_of: Column) -> DataFrame:
    """(source, context, lang_source) of titles and abstracts to translate: not English, and not done or asked within a day."""
    asked = queue.where(F.col("target").isNotNull() | (F.col("date_inserted") > as_of - F.expr("INTERVAL 1 DAY"))).select(F.coalesce("context", F.lit("")).alias("context"))
    rows = records.where(present(F.col("language")) & ~F.upper("language").isin("EN", "ENG"))
    rows = L.not_exists(rows, "identifier", asked, "context")
    texts = F.filter(F.array("title", "abstract"), lambda x: x.isNotNull() & (x != ""))
    return rows.select(F.explode(texts).alias("source"), F.col("identifier").alias("context"), F.col("language").alias("lang_source")).distinct()


def translated(records: DataFrame, queue: DataFrame) -> DataFrame:
    """Records with title or abstract replaced where a finished translation has it as its source; a text that is both is the title."""
    ready = queue.where("target IS NOT NULL").groupBy("context", "source").agg(F.min("target").alias("target"))
    a, b = (ready.toDF(f"c{k}", f"s{k}", f"t{k}") for k in (1, 2))
    rows = records.join(a, (F.col("identifier") == F.col("c1")) & (F.col("title") == F.col("s1")), "left").join(b, (F.col("identifier") == F.col("c2")) & (F.col("abstract") == F.col("s2")), "left")
    new = {"title": F.coalesce("t1", "title"), "abstract": F.when(F.col("title").eqNullSafe(F.col("abstract")), F.col("abstract")).otherwise(F.coalesce("t2", "abstract"))}
    return rows.withColumns(new).select(*records.columns)


def employments(people: DataFrame, cache: DataFrame, organisations: DataFrame) -> DataFrame:
    """(person_id, organisation, role, start, end) from cached profiles; the organisation by its registry id, else by name, else as named."""
    from ..functions.text import orcid_date

    part = "year:string, month:string, day:string"
    place = "name:string, ror:string"
    shape = f"groups array<struct<summaries:array<struct<organization:struct<{place}>, role:string, start:struct<{part}>, `end`:struct<{part}>>>>>"
    rows = people.where(present(F.col("orcid"))).withColumn("key", I.last_part(F.col("orcid"))).join(cache.where("status = 200").select("key", F.from_json("body", shape).alias("b")), "key")
    flat = rows.select("id", F.explode(F.flatten(F.transform("b.groups", lambda g: g["summaries"]))).alias("s"))
    day = lambda c: orcid_date(F.col(f"{c}.year"), F.col(f"{c}.month"), F.col(f"{c}.day"))
    flat = flat.select("id", F.col("s.organization.name").alias("name"), F.col("s.organization.ror").alias("ror"), F.col("s.role").alias("role"), day("s.start").alias("start"), day("s.end").alias("end"))
    by_id = organisations.where("ror IS NOT NULL").groupBy(F.col("ror").alias("r")).agg(F.min("id").alias("by_ror"))
    by_name = organisations.groupBy(F.lower("name").alias("n")).agg(F.min("id").alias("by_name"))
    out = flat.join(by_id, F.col("ror") == F.col("r"), "left").join(by_name, F.lower("name") == F.col("n"), "left")
    return out.select(F.col("id").alias("person_id"), F.coalesce("by_ror", "by_name", F.concat(F.lit("new:"), F.col("name"))).alias("organisation"), "role", "start", "end")
