"""Queries of the matching, text, identifier and label operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identifiers as I  # noqa: E741
from .functions import text as X
from .operators import matching as M
from .registry import query, table

LABELS = "SELECT p_name AS label, 'c' || min(p_partkey) AS concept, CAST(min(p_partkey) AS INTEGER) AS pos FROM part GROUP BY p_name"


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """A vocabulary: the names of all parts, the first part of each as its concept."""
    rows = table(spark, sf, "part").groupBy(F.col("p_name").alias("label")).agg(F.min("p_partkey").alias("k"))
    return rows.select("label", F.concat(F.lit("c"), F.col("k").cast("string")).alias("concept"), F.col("k").cast("int").alias("pos"))


SUBJECTS = "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN p_name WHEN p_partkey % 4 = 1 THEN '12 ' || upper(p_name) ELSE replace(p_name, 'e', 'ee') || 's' END AS label FROM part"


def subjects(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.col("p_name")
    text = F.when(k % 4 == 0, name).when(k % 4 == 1, F.concat(F.lit("12 "), F.upper(name))).otherwise(F.concat(F.replace(name, F.lit("e"), F.lit("ee")), F.lit("s")))
    return table(spark, sf, "part").select(k.alias("id"), text.alias("label"))


#: The longest common subsequence of all pairs of distinct keys and labels, a row of the table per step.
SCORED = f"""
WITH RECURSIVE concepts AS ({LABELS}), subjects AS ({SUBJECTS}),
keys AS (SELECT DISTINCT lower(ltrim(regexp_replace(ltrim(label), '^[0-9]+', ''))) AS key FROM subjects),
lcs AS (
  SELECT key, label, 0 AS i, list_transform(range(length(label)), lambda x: 0) AS r FROM keys, concepts
  UNION ALL
  SELECT key, label, i + 1, list_transform(range(1, length(label) + 1), lambda j: list_max(list_transform(range(1, j + 1),
    lambda k: CAST(greatest(r[k], (CASE WHEN k > 1 THEN r[k - 1] ELSE 0 END) + (CASE WHEN substr(label, CAST(k AS BIGINT), 1) = substr(key, i + 1, 1) THEN 1 ELSE 0 END)) AS INTEGER))))
  FROM lcs WHERE i < length(key)),
scored AS (SELECT key, c.concept, c.pos, c.label, CAST(round_even(200.0 * CAST(r[length(c.label)] AS DOUBLE) / (length(key) + length(c.label)), 0) AS INTEGER) AS score
  FROM lcs JOIN concepts c USING (label) WHERE i = length(key))
"""


def keyed(spark: SparkSession, sf: str) -> DataFrame:
    return subjects(spark, sf).withColumn("key", F.lower(X.label_key(F.col("label"))))


@query(f"""
{SCORED}, best AS (SELECT key, concept, label, score, row_number() OVER (PARTITION BY key ORDER BY score DESC, pos, label) AS k FROM scored WHERE score >= 80)
SELECT s.id, b.concept, b.label AS matched, b.score FROM subjects s JOIN best b ON b.key = lower(ltrim(regexp_replace(ltrim(s.label), '^[0-9]+', ''))) WHERE b.k = 1
""")
def fuzzy_best_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = keyed(spark, sf)
    best = M.best_label(M.fuzzy_scores(rows, labels(spark, sf), 80), ["key"])
    return rows.select("id", "key").join(best, "key").select("id", "concept", F.col("label").alias("matched"), "score")


@query(f"{SCORED} SELECT key, concept, label, score FROM scored WHERE score >= 60 AND length(key) > 4")
def fuzzy_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return M.fuzzy_scores(keyed(spark, sf).where("length(key) > 4"), labels(spark, sf), 60).select("key", "concept", "label", "score")


@query(f"""
WITH concepts AS ({LABELS}), subjects AS ({SUBJECTS}),
hit AS (SELECT s.id, c.concept, c.label, row_number() OVER (PARTITION BY s.id ORDER BY c.pos, c.label) AS k FROM subjects s
  JOIN concepts c ON lower(c.label) = lower(ltrim(regexp_replace(ltrim(s.label), '^[0-9]+', ''))))
SELECT id, concept, label AS matched FROM hit WHERE k = 1
""")
def exact_label(spark: SparkSession, sf: str) -> DataFrame:
    found = M.exact(subjects(spark, sf), labels(spark, sf), "id", X.label_key(F.col("label")))
    return found.select(F.col("subject").alias("id"), "concept", F.col("label").alias("matched"))


@query("""
WITH uris AS (SELECT s_suppkey AS concept, unnest(['u:' || (s_suppkey % 40), 'u:' || (s_suppkey + 7)]) AS uri FROM supplier)
SELECT c_custkey, min(concept) AS concept FROM customer JOIN uris ON uri = 'u:' || (c_custkey % 200) GROUP BY c_custkey
""")
def uri_in_array(spark: SparkSession, sf: str) -> DataFrame:
    u = lambda x: F.concat(F.lit("u:"), x.cast("string"))
    k = F.col("s_suppkey")
    uris = table(spark, sf, "supplier").select(k.alias("concept"), F.explode(F.array(u(k % 40), u(k + 7))).alias("uri"))
    c = table(spark, sf, "customer").select("c_custkey", u(F.col("c_custkey") % 200).alias("uri"))
    return c.join(uris, "uri").groupBy("c_custkey").agg(F.min("concept").alias("concept"))


CASCADE = f"""
{SCORED}, best AS (SELECT key, concept, row_number() OVER (PARTITION BY key ORDER BY score DESC, pos, label) AS k FROM scored WHERE score >= 80),
k AS (SELECT id, lower(ltrim(regexp_replace(ltrim(label), '^[0-9]+', ''))) AS key FROM subjects),
s1 AS (SELECT id, 'u' || (id // 50) AS concept FROM subjects WHERE id % 50 = 0),
s2 AS (SELECT k.id, arg_min(c.concept, c.pos) AS concept FROM k JOIN concepts c ON lower(c.label) = k.key WHERE k.id NOT IN (SELECT id FROM s1) GROUP BY k.id),
s3 AS (SELECT k.id, b.concept FROM k JOIN best b ON b.key = k.key AND b.k = 1 WHERE k.id NOT IN (SELECT id FROM s1) AND k.id NOT IN (SELECT id FROM s2)),
f AS (SELECT *, 'url_match' AS method FROM s1 UNION ALL SELECT *, 'exact_match' FROM s2 UNION ALL SELECT *, 'fuzzy' FROM s3),
res AS (SELECT k.id AS subject, f.concept, coalesce(f.method, 'no_match') AS method FROM k LEFT JOIN f ON f.id = k.id)
"""


def cascade_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows, vocabulary = keyed(spark, sf), labels(spark, sf)
    by_url = rows.where("id % 50 = 0").select(F.col("id").alias("subject"), F.concat(F.lit("u"), F.expr("cast(id div 50 as string)")).alias("concept"))
    by_label = M.exact(rows, vocabulary, "id", F.col("key"))
    best = M.best_label(M.fuzzy_scores(rows, vocabulary, 80), ["key"])
    fuzzy = rows.select(F.col("id").alias("subject"), "key").join(best, "key").select("subject", "concept")
    return M.cascade(rows, [("url_match", by_url), ("exact_match", by_label), ("fuzzy", fuzzy)], "id")


@query(f"{CASCADE} SELECT subject, concept, method FROM res")
def match_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return cascade_rows(spark, sf).select("subject", "concept", "method")


@query(f"{CASCADE} SELECT method, count(*) AS n FROM res GROUP BY method")
def method_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return cascade_rows(spark, sf).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 20 = 0), c AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query, c.vec_id AS vec, round(list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))), 6) AS score FROM q, c WHERE q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec) AS rank FROM s WHERE score >= 0.1)
SELECT query, vec, score, rank FROM r WHERE rank <= 15
""")
def embedding_top_k(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return M.top_k(e.where("id % 20 = 0"), e, 15, 0.1)


@query("""
SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)) AS host,
  CASE WHEN lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)) LIKE '%example.com%' THEN 'com' WHEN lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)) LIKE '%example.net%' THEN 'net' ELSE 'unknown' END AS repository
FROM pages
""")
def repository_of_page(spark: SparkSession, sf: str) -> DataFrame:
    rules = [("example.com", "com"), ("example.net", "net")]
    return table(spark, sf, "pages").select("page_id", I.host(F.col("url")).alias("host"), I.repository(F.col("url"), rules).alias("repository"))


@query(r"""
SELECT page_id, list_sort(list_distinct(list_filter(regexp_extract_all(html, 'href\s*=\s*["'']([^"'']+)["'']', 1),
  lambda h: contains(lower(h), 'page') OR contains(lower(h), 'http') OR contains(lower(h), '/n')))) AS links FROM pages
""")
def links_of_page(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.array_sort(I.page_links(F.col("html"), ["page", "http", "/n"])).alias("links"))


@query("""
SELECT page_id, CASE page_id % 6 WHEN 0 THEN '10.7554/eLife.' || page_id WHEN 1 THEN '10.5281/zenodo.' || page_id WHEN 2 THEN '10.1234/a' || page_id WHEN 3 THEN '10.1234/b.' || page_id WHEN 4 THEN '10.13039/' || (page_id + 1000) END AS doi,
  page_id % 6 = 4 AS funder FROM pages
""")
def dois_of_strings(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    text = (
        F.when(F.col("page_id") % 6 == 0, F.concat(F.lit("https://elifesciences.org/articles/"), k))
        .when(F.col("page_id") % 6 == 1, F.concat(F.lit("see https://zenodo.org/records/"), k, F.lit("/files")))
        .when(F.col("page_id") % 6 == 2, F.concat(F.lit("https://doi.org/10.1234/a"), k, F.lit("?x=1")))
        .when(F.col("page_id") % 6 == 3, F.concat(F.lit("(doi:10.1234/b."), k, F.lit(").")))
        .when(F.col("page_id") % 6 == 4, F.concat(F.lit("10.13039/"), (F.col("page_id") + 1000).cast("string")))
        .otherwise(F.concat(F.lit("none "), k))
    )
    doi = I.doi_of(text)
    return table(spark, sf, "pages").select("page_id", doi.alias("doi"), I.is_funder(doi).alias("funder"))


@query("""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'http://x/' || page_id WHEN 1 THEN 'https://ror.org/r' || page_id WHEN 2 THEN 'https://doi.org/10.1/' || page_id WHEN 3 THEN 'https://orcid.org/o' || page_id ELSE 'https://doi.org/10.5/' || page_id END AS link,
  CASE page_id % 5 WHEN 0 THEN 'uri' WHEN 4 THEN 'doi' ELSE 'uuid' END AS kind FROM pages
""")
def links_of_identifiers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    of = lambda p: F.concat(F.lit(p), k)
    m = F.col("page_id") % 5
    pid = F.when(m == 0, of("http://x/")).when(m == 1, of("ROR:r")).when(m == 2, of("doi:10.1/")).when(m == 3, of("orcid:o")).otherwise(of("10.5/"))
    return table(spark, sf, "pages").select("page_id", I.url_of(pid).alias("link"), I.pid_kind(pid).alias("kind"))


@query("""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN '10.1/a' || page_id WHEN 1 THEN '10.5281/zenodo.' || page_id WHEN 2 THEN 'r' || page_id WHEN 3 THEN 'https://zenodo.org/records/' || page_id ELSE 'plain' END AS deposit FROM pages
""")
def deposits_of_addresses(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id").cast("string")
    m = F.col("page_id") % 5
    uri = F.when(m == 0, "x").when(m == 1, F.concat(F.lit("https://zenodo.org/record/"), k, F.lit("/files?y"))).when(m == 3, F.concat(F.lit("https://zenodo.org/records/"), k)).otherwise("plain")
    first, last = F.when(m == 0, "https://zenodo.org/record/9"), F.when(m == 0, F.concat(F.lit("https://doi.org/10.1/a"), k, F.lit("?z"))).when(m == 2, F.concat(F.lit("https://x/geonetwork/r"), k, F.lit("?q")))
    return table(spark, sf, "pages").select("page_id", I.deposit_id(uri, F.array_compact(F.array(first, last))).alias("deposit"))


@query("""
SELECT p_partkey, list_concat([p_name], CASE WHEN p_size % 2 = 0 THEN [p_type] ELSE [] END) AS names, CASE WHEN p_size % 3 = 0 THEN 'b' || p_brand ELSE 'k' || p_partkey END AS identifier, 'CreativeWork' AS kind FROM part
""")
def schema_org_fields(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.schema_org import merged

    one = lambda x: F.array(x)
    empty = F.array().cast("array<string>")
    record = F.create_map(
        F.lit("name"), one(F.col("p_name")), F.lit("title"), F.when(F.col("p_size") % 2 == 0, one(F.col("p_type"))).otherwise(one(F.lit(""))),
        F.lit("id"), F.when(F.col("p_size") % 3 == 0, one(F.concat(F.lit("b"), F.col("p_brand")))).otherwise(empty), F.lit("url"), one(F.concat(F.lit("k"), F.col("p_partkey").cast("string"))),
    )
    rows = table(spark, sf, "part").select("p_partkey", merged(record).alias("m"))
    return rows.select("p_partkey", F.col("m")["name"].alias("names"), F.col("m")["identifier"][0].alias("identifier"), F.col("m")["@type"][0].alias("kind"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN ['eea39'] ELSE [] END AS concrete, CASE WHEN c_custkey % 3 = 0 THEN ['europe'] ELSE [] END AS broad,
  CASE c_custkey % 5 WHEN 0 THEN ['france', 'germany'] WHEN 1 THEN ['spain'] ELSE [] END AS countries FROM customer
""")
def place_keywords(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.places import split_places

    k = F.col("c_custkey")
    five = F.when(k % 5 == 0, " Deutschland, FRANCE,germany").when(k % 5 == 1, "España").otherwise("atlantis")
    text = F.concat_ws(",", F.when(k % 4 == 0, "EEA39"), F.when(k % 3 == 0, " Europe "), five)
    return table(spark, sf, "customer").select("c_custkey", split_places(text).alias("p")).select("c_custkey", "p.concrete", "p.broad", "p.countries")


@query("""
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ['germany', 'united kingdom'] WHEN 1 THEN [] END AS countries, CASE s_suppkey % 4 WHEN 0 THEN [] WHEN 1 THEN ['global'] END AS broad FROM supplier
""")
def places_in_text(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.places import scan

    m = F.col("s_suppkey") % 4
    text = F.when(m == 0, "Soils of the U.K. and Germany, Austria¹⁰").when(m == 1, "Global peat atlas under global warming").when(m == 2, "europeanised Germanys, global warming")
    return table(spark, sf, "supplier").select("s_suppkey", scan(text).alias("p")).select("s_suppkey", "p.countries", "p.broad")


@query("""
WITH n AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n_citing FROM lineitem GROUP BY l_partkey) SELECT p_partkey, n_citing FROM part LEFT JOIN n ON p_partkey = l_partkey
""")
def citations_merged(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.aggregates import cited_by

    cited = cited_by(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("reference"), F.col("l_suppkey").alias("citing")))
    return table(spark, sf, "part").join(cited, F.col("p_partkey") == F.col("reference"), "left").select("p_partkey", "n_citing")


@query("""
SELECT conv_id, turn, len(list_distinct(list_filter(regexp_split_to_array(text, '[ ,.!;:]+'), lambda w: w <> ''))) AS n_words FROM conversations
""")
def distinct_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", F.size(X.words(F.col("text"))).cast("long").alias("n_words"))


@query("""
SELECT doc_id, regexp_matches(lower(text), '(^|[^a-z])the([^a-z]|$)') AS has_the, regexp_matches(lower(text), '(^|[^a-z])der([^a-z]|$)') AS has_der FROM documents
""")
def terms_of_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.has_term(F.col("text"), "the").alias("has_the"), X.has_term(F.col("text"), "der").alias("has_der"))


@query("""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), 'https?://[^\\s]+', ' ', 'g'), '10\\.[0-9]{4,9}/[^\\s]+', ' ', 'g'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS text FROM pages
""")
def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.strip_noise(F.col("html")).alias("text"))


@query("""
SELECT doc_id, lang, CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' WHEN 'fr' THEN 'fr' END AS code FROM documents
""")
def iso_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes = [("en", "eng"), ("de", "ger|deu"), ("fr", "fre|fra")]
    known = F.when(F.col("lang") == "fr", "FRA").when(F.col("lang") == "de", "ger").when(F.col("lang") == "es", "zzz").otherwise(F.col("lang"))
    return table(spark, sf, "documents").select("doc_id", "lang", X.iso_language(known, codes).alias("code"))


@query("""
WITH t AS (SELECT 'n' || n_nationkey AS s, 'prefLabel' AS p, n_name AS o, 'en' AS lang FROM nation UNION ALL
  SELECT 'n' || n_nationkey, 'altLabel', r_name, 'fr' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0 UNION ALL
  SELECT 'n' || n_nationkey, 'exactMatch', 'x:' || n_nationkey, NULL FROM nation WHERE n_nationkey % 3 = 0)
SELECT a.s AS concept, a.o AS pref, b.o AS alt, c.o AS exact FROM t a LEFT JOIN t b ON b.s = a.s AND b.p = 'altLabel' LEFT JOIN t c ON c.s = a.s AND c.p = 'exactMatch' WHERE a.p = 'prefLabel'
""")
def graph_pattern(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.graph import pattern

    return pattern(_triples(spark, sf), "prefLabel", {"altLabel": "alt", "exactMatch": "exact"}).select(F.col("s").alias("concept"), F.col("o").alias("pref"), "alt", "exact")


@query("""
SELECT 'n' || n_nationkey AS concept, list_sort(list_concat([n_name], CASE WHEN n_nationkey % 2 = 0 THEN [r_name] ELSE [] END)) AS labels FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def label_map(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.graph import label_maps

    maps = label_maps(_triples(spark, sf), ["prefLabel", "altLabel"])
    return maps.select(F.col("s").alias("concept"), F.array_sort(F.flatten(F.map_values("labels"))).alias("labels"))


def _triples(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 rows
    s = F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("s")
    row = lambda p, o, lang: (s, F.lit(p).alias("p"), o.alias("o"), F.lit(lang).cast("string").alias("lang"), F.lit(0).alias("pos"))
    pref = n.select(*row("prefLabel", F.col("n_name"), "en"))
    alt = n.where("n_nationkey % 2 = 0").select(*row("altLabel", F.col("r_name"), "fr"))
    same = n.where("n_nationkey % 3 = 0").select(*row("exactMatch", F.concat(F.lit("x:"), F.col("n_nationkey").cast("string")), None))
    return pref.unionByName(alt).unionByName(same)


@query()
def text_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(X.chunks(F.col("text"), 200, 900)).alias("chunk", "text"))


@query("""
WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '[ ,.!;:]+'), lambda v: v <> '') AS ws FROM conversations),
g AS (SELECT conv_id, turn, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM w),
t AS (SELECT conv_id, turn, term, count(*) AS tf FROM g GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM t GROUP BY term),
s AS (SELECT conv_id, turn, term, round(tf * ln((SELECT count(*) FROM conversations) / df), 6) AS score FROM t JOIN d USING (term)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, term) AS k FROM s)
SELECT conv_id, turn, term, score FROM r WHERE k <= 5
""")
def keyphrases(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.keywords import tfidf

    words = F.filter(F.split(F.lower("text"), r"[ ,.!;:]+"), lambda w: w != "")
    return tfidf(table(spark, sf, "conversations"), ["conv_id", "turn"], words)


#: Landing pages made from parts: host, path and what the links of each should be, by SQL.
_PAGES = """pages_made AS (SELECT p_partkey AS id, CASE p_partkey % 9 WHEN 0 THEN 'https://onlinelibrary.wiley.com/doi/10.1002/' || p_size WHEN 1 THEN 'https://LINK.springer.com/article/10.1007/s' || p_size
  WHEN 2 THEN 'http://www.sciencedirect.com/science/article/pii/S' || p_partkey || '?via=x' WHEN 3 THEN 'https://pubs.acs.org/doi/10.1021/' || p_size WHEN 4 THEN 'https://pubs.rsc.org/en/content/articlelanding/2020/' || p_size
  WHEN 5 THEN 'https://www.nature.com/articles/n' || p_size WHEN 6 THEN 'https://www.pnas.org/doi/abs/' || p_size WHEN 7 THEN 'https://entrepot.recherche.data.gouv.fr/dataset.xhtml?persistentId=doi:10.5/' || p_size
  ELSE 'https://zenodo.org/records/' || p_partkey || '/' END AS url FROM part)"""


@query(f"""
WITH {_PAGES}, m AS (SELECT *, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS root, lower(regexp_extract(url, '^[a-z]+://([^/]*)', 1)) AS host FROM pages_made)
SELECT id, CASE WHEN host LIKE '%wiley%' THEN ['https://agupubs.onlinelibrary.wiley.com/doi/pdf/' || split_part(url, '/doi/', 2)] WHEN host LIKE '%springer%' THEN [root || '/content/pdf/' || split_part(url, '/article/', 2) || '.pdf']
  WHEN host LIKE '%sciencedirect%' THEN [root || '/science/article/pii/' || regexp_extract(url, '/pii/([A-Z0-9]+)', 1) || '/pdfft'] WHEN host LIKE '%acs.org' OR host LIKE '%pnas.org' THEN [root || '/doi/pdf/' || split_part(url, '/doi/', 2)]
  WHEN host LIKE '%rsc.org' THEN [replace(url, '/articlelanding/', '/articlepdf/')] WHEN host LIKE '%nature.com' THEN [root || '/articles/' || split_part(url, '/articles/', 2) || '.pdf'] ELSE [] END AS files,
  CASE WHEN host LIKE '%zenodo%' THEN 'https://zenodo.org/api/records/' || regexp_extract(url, '([0-9]+)/$', 1) WHEN host LIKE '%gouv.fr' THEN split_part(url, '/dataset', 1) || '/api/datasets/:persistentId/?persistentId=' || split_part(url, 'persistentId=', 2) END AS answer FROM m
""")
def files_of_addresses(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.downloads import answer_address, files_of

    k, size, key = F.col("p_partkey") % 9, F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    url = (
        F.when(k == 0, F.concat(F.lit("https://onlinelibrary.wiley.com/doi/10.1002/"), size)).when(k == 1, F.concat(F.lit("https://LINK.springer.com/article/10.1007/s"), size))
        .when(k == 2, F.concat(F.lit("http://www.sciencedirect.com/science/article/pii/S"), key, F.lit("?via=x"))).when(k == 3, F.concat(F.lit("https://pubs.acs.org/doi/10.1021/"), size))
        .when(k == 4, F.concat(F.lit("https://pubs.rsc.org/en/content/articlelanding/2020/"), size)).when(k == 5, F.concat(F.lit("https://www.nature.com/articles/n"), size))
        .when(k == 6, F.concat(F.lit("https://www.pnas.org/doi/abs/"), size)).when(k == 7, F.concat(F.lit("https://entrepot.recherche.data.gouv.fr/dataset.xhtml?persistentId=doi:10.5/"), size))
        .otherwise(F.concat(F.lit("https://zenodo.org/records/"), key, F.lit("/")))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), files_of(url).alias("files"), answer_address(url).alias("answer"))


@query("""
WITH d AS (SELECT c_custkey AS id, 'see https://doi.org/10.1234/' || lower(replace(c_name, '#', '.')) || ', doi:10.5555/x' || c_nationkey || '; or 10.4321/ab(' || c_nationkey || ').' || CASE WHEN c_custkey % 3 = 0 THEN ' https://zenodo.org/record/' || c_custkey ELSE '' END AS t FROM customer)
SELECT id, list_concat(CASE WHEN t LIKE '%zenodo%' THEN ['10.5281/zenodo.' || regexp_extract(t, 'record/([0-9]+)', 1)] ELSE [] END,
  list_transform(list_filter(string_split(t, ' '), lambda w: regexp_matches(w, '10[.][0-9]{4}/')), lambda w: regexp_replace(regexp_replace(w, '^.*?(10[.][0-9]{4}/)', '\\1'), '[.,;:)]+$', ''))) AS dois FROM d
""")
def dois_in_text(spark: SparkSession, sf: str) -> DataFrame:
    from .functions.identifiers import all_dois

    key = F.col("c_custkey").cast("string")
    name = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    nation = F.col("c_nationkey").cast("string")
    text = F.concat(F.lit("see https://doi.org/10.1234/"), name, F.lit(", doi:10.5555/x"), nation, F.lit("; or 10.4321/ab("), nation, F.lit(")."), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" https://zenodo.org/record/"), key)).otherwise(F.lit("")))
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), all_dois(text).alias("dois"))


@query("""
WITH h AS (SELECT page_id, url, html FROM pages), m AS (SELECT page_id, 'https://files.example/' || page_id || '.pdf' AS pdf, 'https://data.example/' || page_id AS data FROM h)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN [pdf] WHEN 1 THEN [data || '.csv', data || '.zip'] WHEN 2 THEN [data || '.csv'] ELSE [] END AS files FROM m
""")
def declared_files_of_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with what publishers declare put in front of them: a tag, lists and single objects of JSON-LD, or damaged JSON."""
    from .functions.downloads import declared_files

    k, key = F.col("page_id") % 4, F.col("page_id").cast("string")
    ld = lambda x: F.concat(F.lit('<script type="application/ld+json">'), x, F.lit("</script>"))
    pdf = F.concat(F.lit("<META content='https://files.example/"), key, F.lit(""".pdf' name="citation_pdf_url">"""))
    many = ld(F.concat(F.lit('[{"@type":"Thing"},{"distribution":[{"contentUrl":"https://data.example/'), key, F.lit('.csv"},{"downloadUrl":"https://data.example/'), key, F.lit('.zip"},"x"]}]')))
    one = F.concat(ld(F.concat(F.lit('{"distribution":[{"contentUrl":"https://data.example/'), key, F.lit('.csv"}]}'))), ld(F.lit('{"distribution":[{"contentUrl":')))
    head = F.when(k == 0, F.concat(pdf, one)).when(k == 1, many).when(k == 2, one).otherwise(ld(F.lit('{"distribution":{"contentUrl":"y"}}')))
    return table(spark, sf, "pages").select("page_id", declared_files(F.concat(head, F.col("html"))).alias("files"))
