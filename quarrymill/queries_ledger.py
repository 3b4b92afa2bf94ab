"""Queries of the incremental and relational operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import aggregates as A
from .operators import ledger as L
from .registry import query, table

AS_OF = "1998-07-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


@query("""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority ILIKE '1-urgent')
""")
def pending_not_in(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").where(F.col("o_orderpriority").ilike("1-urgent"))
    return L.not_in(table(spark, sf, "customer"), "c_custkey", done, "o_custkey").select("c_custkey", "c_name")


@query("""
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END FROM orders WHERE o_orderstatus = 'P')
""")
def pending_not_in_null_trap(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("k"))
    return L.not_in(table(spark, sf, "customer"), "c_custkey", done, "k").select("c_custkey")


@query("""
SELECT p_partkey, p_name FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_quantity > 40)
""")
def pending_not_exists(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "lineitem").where("l_quantity > 40")
    return L.not_exists(table(spark, sf, "part"), "p_partkey", done, "l_partkey").select("p_partkey", "p_name")


@query(f"""
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '{AS_OF}' - INTERVAL 10 DAYS)
""")
def pending_stale(spark: SparkSession, sf: str) -> DataFrame:
    rows = L.stale(table(spark, sf, "customer"), "c_custkey", table(spark, sf, "orders"), "o_custkey", "o_orderdate", as_of(), 10)
    return rows.select("c_custkey", "c_acctbal")


@query("""
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN events e ON d.doc_id = e.user_id AND e.event_type = 'purchase'
WHERE e.user_id IS NULL
""")
def pending_left_join_null(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "events").where("event_type = 'purchase'")
    return L.not_exists(table(spark, sf, "documents"), "doc_id", done, "user_id").select("doc_id", "lang")


@query("""
SELECT s_suppkey, (SELECT min(l_shipdate) FROM lineitem WHERE l_suppkey = s_suppkey) AS first_ship
FROM supplier WHERE s_name NOT LIKE '%7' AND coalesce(s_name, '') <> ''
""")
def scalar_subquery_any(spark: SparkSession, sf: str) -> DataFrame:
    one = L.any_value(table(spark, sf, "lineitem"), "l_suppkey", "l_shipdate", "first_ship")
    rows = table(spark, sf, "supplier").where(~F.col("s_name").like("%7") & (F.coalesce("s_name", F.lit("")) != ""))
    return rows.join(one, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", "first_ship")


@query("""
SELECT user_id, count(*) AS n_items FROM events
WHERE event_type = 'view' AND user_id NOT IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND value > 90)
  AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 90)
GROUP BY user_id
""")
def pending_two_ledgers_counted(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    rows = L.not_exists(e.where("event_type = 'view'"), "user_id", e.where("event_type = 'error' AND value > 90"), "user_id")
    rows = L.not_exists(rows, "user_id", e.where("event_type = 'signup' AND value > 90"), "user_id")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))


@query("""
SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l_returnflag = 'R' AND (l_tax > 0.04) IS FALSE AND o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def links_left_and_semi(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R'").where((F.col("l_tax") > 0.04).eqNullSafe(F.lit(False)))
    poor = table(spark, sf, "customer").where("c_acctbal < 0")
    orders = table(spark, sf, "orders").join(poor, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_custkey")


@query("""
WITH old AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 <> 0),
     new AS (SELECT o_custkey AS id, min('order ' || o_orderkey) AS name FROM orders GROUP BY o_custkey)
SELECT id, name FROM old UNION ALL SELECT id, name FROM new WHERE id NOT IN (SELECT id FROM old)
""")
def append_ignoring_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"))
    return L.append_new(old, new, ["id"])


@query("""
SELECT doc_id, lang FROM documents
WHERE coalesce(lang, '') <> '' AND coalesce(text, '') <> '' AND upper(lang) NOT IN ('EN', 'ENG')
  AND doc_id NOT IN (SELECT coalesce(doc_id, -1) FROM labels WHERE toxic = 1 OR quality = 0)
""")
def translatable_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where(X.present(F.col("lang")) & X.present(F.col("text")) & ~F.upper("lang").isin("EN", "ENG"))
    return L.not_exists(rows, "doc_id", table(spark, sf, "labels").where("toxic = 1 OR quality = 0"), "doc_id").select("doc_id", "lang")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'
  AND (o_orderpriority IS NULL OR o_orderpriority LIKE '5%' OR o_orderdate < TIMESTAMP '1998-06-30 00:00:00')
""")
def retry_after_a_day(spark: SparkSession, sf: str) -> DataFrame:
    old = F.col("o_orderdate") < as_of() - F.expr("INTERVAL 1 DAY")
    return table(spark, sf, "orders").where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority").isNull() | F.col("o_orderpriority").like("5%") | old)).select("o_orderkey")


@query("""
SELECT p_partkey, coalesce(n.brand, p.p_brand) AS p_brand FROM part p
LEFT JOIN (SELECT l_partkey, 'B' || count(*) AS brand FROM lineitem WHERE l_quantity = 50 GROUP BY l_partkey) n ON n.l_partkey = p.p_partkey
""")
def keyed_update(spark: SparkSession, sf: str) -> DataFrame:
    new = table(spark, sf, "lineitem").where("l_quantity = 50").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.concat(F.lit("B"), F.count(F.lit(1)).cast("string")).alias("p_brand"))
    return L.update(table(spark, sf, "part").select("p_partkey", "p_brand"), new, ["p_partkey"], "p_brand")


@query("""
SELECT DISTINCT c_custkey, s_suppkey FROM customer, supplier
WHERE c_custkey = s_suppkey OR (c_acctbal = s_acctbal)
""")
def join_on_either_key(spark: SparkSession, sf: str) -> DataFrame:
    return L.either_key(table(spark, sf, "customer"), table(spark, sf, "supplier"), [("c_custkey", "s_suppkey"), ("c_acctbal", "s_acctbal")], ["c_custkey", "s_suppkey"])


@query("""
WITH tr AS (SELECT DISTINCT p_type AS source, lower(p_type) || '-xx' AS target FROM part WHERE p_size > 5)
SELECT p_partkey, CASE WHEN a.target IS NOT NULL THEN a.target ELSE p_type END AS title,
       CASE WHEN a.target IS NULL AND b.target IS NOT NULL THEN b.target ELSE p_name END AS abstract
FROM part LEFT JOIN tr a ON p_type = a.source LEFT JOIN tr b ON p_name = b.source
""")
def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    tr = part.where("p_size > 5").select(F.col("p_type").alias("source"), F.concat(F.lower("p_type"), F.lit("-xx")).alias("target")).distinct()
    a, b = tr.toDF("s1", "t1"), tr.toDF("s2", "t2")
    rows = part.join(a, F.col("p_type") == F.col("s1"), "left").join(b, F.col("p_name") == F.col("s2"), "left")
    return rows.select("p_partkey", F.coalesce("t1", "p_type").alias("title"), F.when(F.col("t1").isNull() & F.col("t2").isNotNull(), F.col("t2")).otherwise(F.col("p_name")).alias("abstract"))


@query("""
SELECT c_custkey, coalesce(s.s_name, n.n_name, 'new:' || c_mktsegment) AS organisation
FROM customer LEFT JOIN supplier s ON c_custkey = s_suppkey LEFT JOIN nation n ON c_nationkey = n_nationkey AND n_nationkey % 2 = 0
""")
def ordered_fallback(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation").where("n_nationkey % 2 = 0")
    rows = L.first_of(c, [(s, F.col("c_custkey") == F.col("s_suppkey"), F.col("s_name")), (n, F.col("c_nationkey") == F.col("n_nationkey"), F.col("n_name"))], "found")
    return rows.select("c_custkey", F.coalesce("found", F.concat(F.lit("new:"), F.col("c_mktsegment"))).alias("organisation"))


@query("""
SELECT o_custkey, o_orderkey, n_rows FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n_rows FROM orders)
WHERE k = 1
""")
def keep_first_by_identifier(spark: SparkSession, sf: str) -> DataFrame:
    return L.keep_first(table(spark, sf, "orders"), "o_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "n_rows")


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS record_id, 'type' AS property, CASE p_type WHEN 'ECONOMY' THEN 'Dataset' WHEN 'PROMO' THEN 'Journal Article' END AS value, 'elements' AS process FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'size', CAST(p_size AS VARCHAR), 'elements' FROM part
""")
def augment_rows(spark: SparkSession, sf: str) -> DataFrame:
    from .operators.matching import dictionary

    mapping = spark.createDataFrame([("Economy", "Old", 0), ("ECONOMY", "Dataset", 1), ("promo", "Journal Article", 2), ("small", "", 3)], "source_label string, target_label string, pos int")
    rows = dictionary(table(spark, sf, "part"), "p_type", mapping, "mapped")
    return L.augment(rows, "p_partkey", {"type": F.col("mapped"), "size": F.col("p_size")}, "elements", as_of()).drop("date")


@query("""
SELECT c_custkey, round(100.0 * (10 * (CASE WHEN c_custkey IS NOT NULL THEN 1 ELSE 0 END) + 20 * (CASE WHEN coalesce(c_name, '') <> '' THEN 1 ELSE 0 END)
  + 10 * (CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END) + 5 * (CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END)) / 170.0, 1) AS score
FROM customer
""")
def completeness_score(spark: SparkSession, sf: str) -> DataFrame:
    fields = {
        "identifier": F.col("c_custkey"), "title": F.col("c_name"), "abstract": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "language": F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(""),
    }
    return table(spark, sf, "customer").select("c_custkey", A.completeness(fields).alias("score"))


@query("""
SELECT o_orderpriority AS vocabulary, o_orderstatus AS keywords_type, count(DISTINCT o_custkey) AS group_count, count(*) AS value_count,
  CASE WHEN o_orderstatus = 'F' THEN 'scope_tag' WHEN o_orderstatus = 'P' THEN 'place_keyword' ELSE 'dropped' END AS routed_band,
  list_slice(list_sort(list(DISTINCT CAST(o_orderkey % 97 AS INTEGER))), 1, 5) AS examples
FROM orders GROUP BY 1, 2, 5
""")
def keyword_group_census(spark: SparkSession, sf: str) -> DataFrame:
    route = F.when(F.col("o_orderstatus") == "F", "scope_tag").when(F.col("o_orderstatus") == "P", "place_keyword").otherwise("dropped")
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("vocabulary"), F.col("o_orderstatus").alias("keywords_type"), route.alias("routed_band"), "o_custkey", (F.col("o_orderkey") % 97).cast("int").alias("x"))
    return A.census(rows, ["vocabulary", "keywords_type", "routed_band"], "o_custkey", "x")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_partkey AS reference, list_sort(list(DISTINCT l_suppkey)) AS citing, count(DISTINCT l_suppkey) AS n_citing
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
""")
def citation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.cited_by(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("reference"), F.col("l_suppkey").alias("citing")))


@query("""
WITH a AS (SELECT c.doc_id, CASE WHEN l.quality = 1 THEN ['good'] ELSE [] END AS t1, CASE WHEN l.toxic = 1 THEN ['toxic'] ELSE [] END AS t2, c.lang FROM labels l JOIN documents c USING (doc_id)),
p AS (SELECT list_concat(t1, t2) AS truth, CASE WHEN lang = 'en' THEN ['good'] WHEN lang = 'fr' THEN ['toxic', 'other'] ELSE [] END AS given FROM a),
s AS (SELECT CAST(sum(len(list_intersect(truth, given))) AS DOUBLE) m, CAST(sum(len(truth)) AS DOUBLE) t, CAST(sum(len(given)) AS DOUBLE) g FROM p)
SELECT round(m / g, 4) AS precision, round(m / t, 4) AS recall, round(2 * (m / g) * (m / t) / (m / g + m / t), 4) AS f1 FROM s
""")
def evaluation_scores(spark: SparkSession, sf: str) -> DataFrame:
    return A.scores(_pairs(spark, sf))


@query("""
WITH a AS (SELECT c.doc_id, CASE WHEN l.quality = 1 THEN ['good'] ELSE [] END AS t1, CASE WHEN l.toxic = 1 THEN ['toxic'] ELSE [] END AS t2, c.lang FROM labels l JOIN documents c USING (doc_id)),
p AS (SELECT list_concat(t1, t2) AS truth, CASE WHEN lang = 'en' THEN ['good'] WHEN lang = 'fr' THEN ['toxic', 'other'] ELSE [] END AS given FROM a),
s AS (SELECT CAST(sum(CASE WHEN len(truth) = 0 THEN 1 ELSE len(list_intersect(truth, given)) END) AS DOUBLE) m, CAST(sum(greatest(len(truth), 1)) AS DOUBLE) t, CAST(sum(greatest(len(given), 1)) AS DOUBLE) g FROM p)
SELECT round(m / g, 4) AS precision, round(m / t, 4) AS recall, round(2 * (m / g) * (m / t) / (m / g + m / t), 4) AS f1 FROM s
""")
def evaluation_scores_legacy(spark: SparkSession, sf: str) -> DataFrame:
    return A.scores(_pairs(spark, sf), legacy=True)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    none = F.array().cast("array<string>")
    truth = F.concat(F.when(F.col("quality") == 1, F.array(F.lit("good"))).otherwise(none), F.when(F.col("toxic") == 1, F.array(F.lit("toxic"))).otherwise(none))
    given = F.when(F.col("lang") == "en", F.array(F.lit("good"))).when(F.col("lang") == "fr", F.array(F.lit("toxic"), F.lit("other"))).otherwise(none)
    return rows.select(truth.alias("truth"), given.alias("given"))


@query("""
SELECT lang, count(*) FILTER (WHERE source <> 'src0') AS curated, count(*) FILTER (WHERE source = 'src0') AS mt, count(*) AS total FROM documents GROUP BY lang
""")
def language_coverage(spark: SparkSession, sf: str) -> DataFrame:
    mt = F.col("source") == "src0"
    return table(spark, sf, "documents").groupBy("lang").agg(F.count_if(~mt).alias("curated"), F.count_if(mt).alias("mt"), F.count(F.lit(1)).alias("total"))


@query("""
WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, max(n) AS n, min(n_chars) AS least, max(CASE WHEN k = n // 4 THEN n_chars END) AS p25, max(CASE WHEN k = n // 2 THEN n_chars END) AS median,
  max(CASE WHEN k = 3 * n // 4 THEN n_chars END) AS p75, max(n_chars) AS most FROM r GROUP BY lang
""")
def sample_description(spark: SparkSession, sf: str) -> DataFrame:
    return A.index_quantiles(table(spark, sf, "documents"), "lang", "n_chars", {"p25": "n div 4", "median": "n div 2", "p75": "3 * n div 4"})


@query("""
SELECT user_id, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS spatial_description FROM events GROUP BY user_id
""")
def entities_joined(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ";").alias("spatial_description"))


@query("""
SELECT user_id, 'description|' || event_type AS property, string_agg(DISTINCT json_extract_string(props, '$.k'), ';' ORDER BY json_extract_string(props, '$.k')) AS value FROM events GROUP BY user_id, event_type
""")
def entities_by_label(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    rows = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.array_join(F.array_sort(F.collect_set(k)), ";").alias("value"))
    return rows.select("user_id", F.concat(F.lit("description|"), F.col("event_type")).alias("property"), "value")


@query("""
SELECT c_nationkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'main' ELSE c_mktsegment END AS table_name, list_sort(list(c_custkey)) AS attributes FROM customer GROUP BY 1, 2
""")
def attributes_by_table(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("c_mktsegment") == "MACHINERY", "main").otherwise(F.col("c_mktsegment"))
    return table(spark, sf, "customer").groupBy("c_nationkey", name.alias("table_name")).agg(F.array_sort(F.collect_list("c_custkey")).alias("attributes"))


@query("""
SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
""")
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").join(table(spark, sf, "supplier"), F.col("c_nationkey") == F.col("s_nationkey"), "left_semi")
    return c.select("c_custkey").subtract(table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("""
SELECT DISTINCT label FROM (SELECT p_name AS label FROM part UNION SELECT p_type FROM part UNION SELECT event_type FROM events) WHERE label IS NOT NULL
""")
def label_union(spark: SparkSession, sf: str) -> DataFrame:
    part, e = table(spark, sf, "part"), table(spark, sf, "events")
    return part.select(F.col("p_name").alias("label")).union(part.select("p_type")).union(e.select("event_type")).distinct().where("label IS NOT NULL")


@query("""
SELECT * FROM (SELECT c_custkey, md5('20260817|' || c_custkey) AS pick FROM customer WHERE c_acctbal > 0) ORDER BY pick, c_custkey LIMIT 50
""")
def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", F.md5(F.concat(F.lit("20260817|"), F.col("c_custkey").cast("string"))).alias("pick"))
    return rows.orderBy("pick", "c_custkey").limit(50)


@query("""
SELECT n_name, c_custkey, rank FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
JOIN nation ON c_nationkey = n_nationkey WHERE rank <= 15
""")
def top_15_per_group(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    top = table(spark, sf, "customer").withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 15")
    return top.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_custkey", "rank")


@query("""
SELECT l_suppkey, min(l_extendedprice) AS w, min(l_quantity) AS s, max(l_extendedprice) AS e, max(l_quantity) AS n FROM lineitem GROUP BY l_suppkey
""")
def bbox_union(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.min("l_extendedprice").alias("w"), F.min("l_quantity").alias("s"), F.max("l_extendedprice").alias("e"), F.max("l_quantity").alias("n"))


@query("""
WITH cache AS (SELECT s_suppkey AS key, CASE WHEN s_suppkey % 5 = 0 THEN 404 ELSE 200 END AS status, s_name AS body FROM supplier)
SELECT p_partkey, CASE WHEN status IS NULL THEN 'pending' WHEN status = 404 THEN 'error' ELSE 'success' END AS status, CASE WHEN status = 200 THEN body END AS body
FROM part LEFT JOIN cache ON p_partkey = key
""")
def external_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    cache = s.select(F.col("s_suppkey").alias("key"), F.when(F.col("s_suppkey") % 5 == 0, 404).otherwise(200).alias("status"), F.col("s_name").alias("body"))
    code = F.when(F.col("status").isNull(), "pending").when(F.col("status") == 404, "error").otherwise("success")
    return table(spark, sf, "part").join(cache, F.col("p_partkey") == F.col("key"), "left").select("p_partkey", code.alias("status"), F.when(F.col("status") == 200, F.col("body")).alias("body"))


@query("""
WITH langs AS (SELECT unnest(['en', 'de', 'fr']) AS lang), slots AS (SELECT DISTINCT p_name AS source, lang FROM part, langs)
SELECT source, lang FROM slots WHERE NOT (lang = 'en') AND (lang, source) NOT IN (SELECT 'de', p_name FROM part WHERE p_size > 25)
""")
def missing_translation_slots(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    slots = part.select(F.col("p_name").alias("source")).distinct().withColumn("lang", F.explode(F.array(*[F.lit(x) for x in ("de", "fr")])))
    cache = part.where("p_size > 25").select(F.lit("de").alias("lang"), F.col("p_name").alias("source")).distinct()
    return slots.join(cache, ["lang", "source"], "left_anti").select("source", "lang")


@query("""
SELECT c_custkey, 'https://doi.org/10.' || (1000 + c_nationkey) || '/' || c_custkey AS identifier FROM customer
WHERE c_custkey % 3 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ORDER BY c_custkey LIMIT 100
""")
def pending_dois(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    identifier = F.when(k % 3 == 0, F.concat(F.lit("urn:10.1/"), k.cast("string"))).otherwise(F.concat(F.lit("https://doi.org/10."), (F.col("c_nationkey") + 1000).cast("string"), F.lit("/"), k.cast("string")))
    rows = table(spark, sf, "customer").select("c_custkey", identifier.alias("identifier"))
    return L.pending_dois(rows, "c_custkey", "identifier", table(spark, sf, "orders").where("o_orderstatus = 'P'"), "o_custkey")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN '0000-' || s_suppkey END AS orcid FROM supplier
WHERE s_suppkey % 4 > 1 AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity < 2) ORDER BY s_suppkey LIMIT 1000
""")
def pending_persons(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    orcid = F.when(k % 4 == 1, "").when(k % 4 > 1, F.concat(F.lit("0000-"), k.cast("string")))
    rows = table(spark, sf, "supplier").select("s_suppkey", orcid.alias("orcid"))
    return L.pending_persons(rows, "s_suppkey", "orcid", table(spark, sf, "lineitem").where("l_quantity < 2"), "l_suppkey")


@query("""
SELECT p_partkey FROM part WHERE p_partkey % 5 IN (0, 1) AND p_size > 10 ORDER BY p_partkey LIMIT 100
""")
def pending_videos(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    link = F.when(k % 5 == 0, F.concat(F.lit("https://www.YouTube.com/watch?v="), k.cast("string"))).when(k % 5 == 1, F.concat(F.lit("https://youtu.be/"), k.cast("string"))).otherwise("https://video.org/youtub")
    rows = table(spark, sf, "part").select("p_partkey", link.alias("identifier"), F.when(F.col("p_size") <= 10, "failed").alias("doimetadata"))
    return L.pending_videos(rows, "p_partkey", "identifier", "doimetadata").select("p_partkey")
