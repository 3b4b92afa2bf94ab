"""Functions, readers and plans on small inputs."""

import json
import math

from pyspark.sql import functions as F

from quarrymill.functions import downloads as DL
from quarrymill.functions import geo as G
from quarrymill.functions import identifiers as I  # noqa: E741
from quarrymill.functions import text as X
from quarrymill.operators import documents as D
from quarrymill.operators import spatial as S
from quarrymill.plans import augmenters as P
from quarrymill.sources import readers as R
from quarrymill.sources import sinks as W


def one(spark, value, col, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col(F.col("x")).alias("y")).first()["y"]


def test_similarity(spark):
    # fixed values: scores that the published matches carry
    pairs = [("microbial activity", "soil microbial activity", 88), ("ecology", "geology", 86), ("carbon", "carbonate", 80), ("water", "weather", 83), ("oil", "soil", 86), ("", "", 100), ("", "a", 0)]
    got = spark.createDataFrame(pairs, "a string, b string, s int").select("s", X.similarity(F.col("a"), F.col("b")).alias("t")).collect()
    assert all(r["s"] == r["t"] for r in got)


def test_labels(spark):
    assert one(spark, "2041 waldboden", X.label_key) == "waldboden"
    assert one(spark, "2041 waldboden", lambda x: X.label_key(x, inner=False)) == " waldboden"
    assert one(spark, "A  thing\nhere. Source: FAO 2", X.clean_definition) == "A thing here."
    assert one(spark, " null ", X.cell) is None and one(spark, " a ", X.cell) == "a"
    primary = lambda m: X.primary_label(m, F.lit("id"))
    kind = "map<string,array<string>>"
    assert one(spark, {"de": ["b"], "en": ["a", "c"]}, primary, kind) == "a" and one(spark, {"de": ["b"]}, primary, kind) == "b" and one(spark, {}, primary, kind) == "id"
    merged = spark.range(1).select(X.merge_labels(F.create_map(F.lit("en"), F.array(F.lit("a"), F.lit("b"))), F.create_map(F.lit("en"), F.array(F.lit("b")), F.lit("de"), F.array(F.lit("c")))).alias("m")).first()["m"]
    assert merged == {"en": ["a", "b"], "de": ["c"]}
    assert one(spark, "Global Soil and global warming potential", lambda x: X.mask_thematic(x, ["warming"])) == "Global Soil and xglobal warming potential"
    assert one(spark, "in european soils", lambda x: X.has_term(x, "europe")) is False and one(spark, "the U.K. map", lambda x: X.has_term(x, "u.k.")) is True
    assert one(spark, "fra", lambda x: X.iso_language(x, [("bg", "bul"), ("fr", "fre|fra")])) == "fr" and one(spark, "", lambda x: X.iso_language(x, [("bg", "bul")])) is None
    day = lambda y, m, d: str(spark.range(1).select(X.orcid_date(F.lit(y), F.lit(m), F.lit(d)).alias("d")).first()["d"])
    assert [day(2020, None, None), day(2020, 2, 3), day(2020, 13, 1)] == ["2020-01-01", "2020-02-03", "None"]


def test_chunks(spark):
    text = "A" * 49 + ". " + "B" * 250 + ". " + "C" * 949 + ". " + "D" * 20 + "."
    got = one(spark, text, lambda x: X.chunks(x, 200, 900))
    assert " ".join(got) == text and len(got) == 2 and got[0].startswith("AAA") and got[1].endswith("D.")


def test_identifiers(spark):
    # fixed values: identifier forms and what they name
    cases = {
        "https://elifesciences.org/articles/123": "10.7554/eLife.123", "https://zenodo.org/record/77": "10.5281/zenodo.77", "https://zenodo.org/records/78": "10.5281/zenodo.78",
        "doi:10.1234/x.y": "10.1234/x.y", "https://doi.org/10.1234/x?z": "10.1234/x", "see 10.1234/x).": "10.1234/x", "none": None,
    }
    assert {x: one(spark, x, I.doi_of) for x in cases} == cases
    assert one(spark, "a 10.1/x no, 10.1234/b. and doi:10.1234/b; 10.5555/(c)", I.all_dois) == ["10.1234/b", "10.5555/(c"]
    assert one(spark, "10.1234/a, doi: 10.1234/b; https://dx.doi.org/10.1234/c) https://elifesciences.org/articles/9", lambda x: I.all_dois(x, strict=True)) == ["10.7554/eLife.9", "10.1234/c", "10.1234/b"]
    assert one(spark, "https://www.youtube.com/watch?v=aB3dE5gH7jK", lambda x: I.video_id(x)["id"]) == "aB3dE5gH7jK"
    assert one(spark, "https://youtu.be/aB3dE5gH7jK?si=B", lambda x: I.video_id(x)["id"]) == "aB3dE5gH7jK"
    assert one(spark, "https://user@zenodo.org:443/x", I.repository) == "zenodo" and one(spark, "https://example.org/zenodo.org", I.repository) == "unknown"
    assert one(spark, "https://www.sciencedirect.com/science/article/pii/S00", DL.files_of) == ["https://www.sciencedirect.com/science/article/pii/S00/pdfft"]
    assert one(spark, "https://www.nature.com/x", DL.files_of) == []
    join = lambda b, t: spark.range(1).select(I.join_url(F.lit(b), F.lit(t)).alias("u")).first()["u"]
    assert [join("https://a.b/c/d?x", t) for t in ("/e", "f", "//g/h", "http://i")] == ["https://a.b/e", "https://a.b/c/f", "https://g/h", "http://i"]
    assert join("https://a.b", "f") == "https://a.b/f"
    assert one(spark, "https://x/collections/items/abc_def", I.record_key) == "abc"


def test_boxes(spark):
    # fixed values: boxes and whether they are valid
    cases = {"[654360, 7847000, 609000, 7880000]": False, "[6.74, 49.42, 5.55, 50.25]": False, "[-180, -90, 180, 100]": False, "[170, 60, -170, 70]": False, "(5.55, 49.42, 6.74, 50.25)": True, "[a, 1, 2, 3]": False, "abcd": False}
    assert {x: one(spark, x, lambda b: G.is_wgs84(G.parse_bbox(b))) for x in cases} == cases
    assert one(spark, "[2, 4, 2, 4]", lambda b: G.shape(G.parse_bbox(b))) == "point" and one(spark, "[2, 4, 3, 4]", lambda b: G.shape(G.parse_bbox(b))) == "line"
    east, north = spark.range(1).select(*G.laea(F.lit(5.0), F.lit(50.0))).first()
    assert math.isclose(east, 3962799.45, abs_tol=0.01) and math.isclose(north, 2999718.85, abs_tol=0.01)
    area = spark.range(1).select(G.bbox_km2(F.lit(6.54747184), F.lit(51.2249633), F.lit(11.74161086), F.lit(53.93431815))).first()[0]
    assert math.isclose(area, 106045.566, abs_tol=0.001)
    xml = '<gmd:EX_GeographicBoundingBox><gmd:westBoundLongitude><gco:Decimal>6.5</gco:Decimal></gmd:westBoundLongitude><gmd:eastBoundLongitude><gco:Decimal>11</gco:Decimal></gmd:eastBoundLongitude><gmd:southBoundLatitude><gco:Decimal>-51.2</gco:Decimal></gmd:southBoundLatitude><gmd:northBoundLatitude><gco:Decimal>53</gco:Decimal></gmd:northBoundLatitude>'  # noqa: E501
    assert tuple(one(spark, xml, R.xml_bbox)) == (6.5, -51.2, 11.0, 53.0) and one(spark, "<x>", R.xml_bbox) is None
    votes = lambda *v: spark.range(1).select(S.agreement(*[F.lit(x) for x in v])).first()[0]
    assert [votes("silent", "silent"), votes("for", "silent"), votes("for", "against")] == ["", "", "disagree"] and votes("for", "for", "silent") == "agree"


def test_ladder(spark):
    land = [("Giant", True, 27.0, 45.0, 60.0, 70.0), ("A", True, 0.0, 45.0, 5.0, 50.0), ("B", True, 5.0, 45.0, 10.0, 50.0), ("Tiny", True, 4.9, 46.0, 5.1, 46.2), ("East", False, 60.0, 40.0, 90.0, 60.0), ("South", False, 0.0, 20.0, 10.0, 44.0)]
    countries = spark.createDataFrame(land, "name string, is_eu boolean, w double, s double, e double, n double")
    boxes = [
        (1, 1.0, 46.0, 2.0, 47.0), (2, 0.0, 45.0, 10.0, 50.0), (3, 70.0, 50.0, 70.0, 50.0), (4, 2.0, 47.0, 2.0, 47.0), (5, 5.0, 46.1, 5.0, 46.1), (6, 1.0, 49.0, 9.0, 49.0), (7, 1.0, 49.0, 5.5, 49.0),
        (8, 0.0, 20.0, 10.0, 45.1), (9, 4.6, 45.9, 5.4, 46.3), (10, 9.0, 45.0, 28.0, 50.0), (11, 100.0, 0.0, 101.0, 1.0),
    ]
    rows = S.classify(spark.createDataFrame(boxes, "id int, w double, s double, e double, n double"), countries, "id", giant="Giant").collect()
    got = {r["id"]: r["classification"].split("_")[0] for r in rows}
    assert got == {1: "single", 2: "multi", 3: "non", 4: "single", 5: "multi", 6: "multi", 7: "single", 8: "non", 9: "single", 10: "single", 11: "non"}
    tiny = next(r for r in rows if r["id"] == 9)
    assert tiny["coverage_top"] == "Tiny" and tiny["coverage_ratio"] > 1.5


def test_documents(spark):
    doc = json.dumps({"identification": {"license": {"name": "CC"}, "rights": "r", "keywords": {"a": {"keywords_type": "theme", "vocabulary": {"name": "Spatial scope"}, "keywords": ["European", None]}}}})
    assert one(spark, doc, lambda x: D.license_name(D.parse(x))) == "CC" and one(spark, "{bad", lambda x: D.keywords(D.parse(x))) == []
    route = lambda v, k: spark.range(1).select(D.route(F.lit(v), F.lit(k))).first()[0]
    assert [route("Spatial scope", "theme"), route("GEMET", "place"), route("Country", None), route("GEMET", "theme")] == ["scope_tag", "place_keyword", "place_keyword", "dropped"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "m.csv").write_text("source_label,target_label\nDataset,Old\ndataset,Dataset\nund,\n")
    m = R.mapping(spark, str(tmp_path / "m.csv"))
    assert [tuple(r)[:2] for r in m.orderBy("pos").collect()] == [("Dataset", "Old"), ("dataset", "Dataset"), ("und", "")]
    (tmp_path / "s.csv").write_text('id,uri,label\n1,NULL,"a, b"\n2,u,\n')
    assert [tuple(r) for r in R.subjects(spark, str(tmp_path / "s.csv")).collect()] == [(1, None, "a, b"), (2, "u", None)]
    (tmp_path / "c.json").write_text(json.dumps([{"identifier": "x", "uris": ["u"], "labels": {"en": ["Soil"]}}, {"identifier": "y", "uris": [], "labels": {"de": ["Wasser"]}}]))
    c = R.concepts(spark, str(tmp_path / "c.json"))
    assert [(r["pos"], r["identifier"]) for r in c.collect()] == [(0, "x"), (1, "y")]
    for k, t in (("1", "old"), ("2", "new")):
        (tmp_path / f"l{k}.json").write_text(json.dumps({"i": {"labels": [k], "text": t}}))
    assert [tuple(r) for r in R.labelled(spark, [str(tmp_path / "l1.json"), str(tmp_path / "l2.json")]).collect()] == [("i", ["2"], "new")]
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"name": "A"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 1], [4, 1], [4, 3], [0, 1]]]}}, {"properties": {"name": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 7], [5, 5]]], [[[8, 1], [9, 2], [8, 1]]]]}}]}))
    g = R.geojson(spark, str(tmp_path / "g.json")).select("name", R.ring_bounds(F.col("rings")).alias("b")).collect()
    assert [(r["name"], *r["b"]) for r in g] == [("A", 0, 1, 4, 3), ("B", 5, 1, 9, 7)]
    ttl = '@prefix x: <http://x/> .\nPREFIX y: <http://y#>\n@base <http://b/> .\n<http://a> <http://p> "one"@en , "zwei"@de ; x:q <c> . # end\n<http://c> a "say \\"hi\\"" .\ny:d x:e [ x:f 1 ] .\nx:g y:h """two\nlines""" ; z:i 7 .'
    t = R.triples(spark.createDataFrame([(1, ttl), (2, None)], "id int, t string"), "id", "t").collect()
    assert [(r["s"], r["p"], r["o"], r["lang"]) for r in t] == [
        ("http://a", "http://p", "one", "en"), ("http://a", "http://p", "zwei", "de"), ("http://a", "http://x/q", "http://b/c", None), ("http://c", R.TYPE, 'say "hi"', None),
        (None, None, "[ x:f 1 ] .", None), ("http://x/g", "http://y#h", "two\nlines", None), ("http://x/g", "z:i", "7", None),
    ]
    assert [r["kind"] for r in t] == ["literal", "literal", "iri", "literal", "unread", "literal", "name"]
    rows = spark.createDataFrame([(1, 'a"b')], "k int, v string")
    W.quoted_csv(rows, str(tmp_path / "out"), ["v", "k"])
    assert spark.read.text(str(tmp_path / "out")).collect()[1][0] == '"a""b","1"'
    assert [W.versioned_json(rows, str(tmp_path / "v")) for _ in range(2)] == [1, 2] and spark.read.json(str(tmp_path / "v/v2")).count() == 1


def test_plans(spark, tmp_path):
    concepts = spark.createDataFrame([(0, "x", ["u"], {"en": ["Soil carbon"]}), (1, "y", [], {"de": ["Wasser"], "en": ["Water"]})], "pos int, identifier string, uris array<string>, labels map<string,array<string>>")
    subjects = spark.createDataFrame([(1, "u", None), (2, "no", "water"), (3, None, "12 soil carbons"), (4, None, None), (5, None, "zzz")], "id long, uri string, label string")
    got = {r["subject"]: (r["concept"], r["method"]) for r in P.keywords(subjects, concepts).collect()}
    assert got == {1: ("x", "url_match"), 2: ("y", "exact_match"), 3: ("x", "fuzzy"), 5: (None, "no_match")}
    assert {r["subject"]: r["method"] for r in P.keywords(subjects, concepts, fallthrough=False).collect()}[2] == "no_match"
    records = spark.createDataFrame([("a", "T", "A", "de"), ("b", "X", "X", "fr"), ("c", "E", "E2", "en")], "identifier string, title string, abstract string, language string")
    queue = spark.createDataFrame([("T", "Title", "a"), ("X", "Ex", "b"), ("A", None, "a")], "source string, target string, context string").withColumn("date_inserted", F.lit("2020-01-01").cast("timestamp"))
    assert [tuple(r)[:3] for r in P.translated(records, queue).orderBy("identifier").collect()] == [("a", "Title", "A"), ("b", "Ex", "X"), ("c", "E", "E2")]
    assert P.translation_requests(records, queue.limit(0), F.lit("2020-06-01").cast("timestamp")).count() == 3
    mapping = spark.createDataFrame([("DE", "German", 0), ("fr", "", 1)], "source_label string, target_label string, pos int")
    done = spark.createDataFrame([("c", "ELEMENTS")], "record_id string, process string")
    rows = P.elements(records, done, {"language": mapping}, F.lit("2020-01-01").cast("timestamp"))
    assert sorted((r["record_id"], r["value"]) for r in rows.collect()) == [("a", "German"), ("b", None)]
    cache = spark.createDataFrame([("10.1234/a", 200, "https://x.org/p/", '<a href="f.pdf">'), ("10.1234/b", 500, None, None)], "doi string, status int, url string, body string")
    recs = spark.createDataFrame([(f"https://doi.org/10.1234/{k}",) for k in "abc"] + [("none",)], "identifier string")
    links, status = P.files(recs, cache)
    assert [r["file_url"] for r in links.collect()] == ["https://x.org/p/f.pdf"] and sorted(r["status"] for r in status.collect()) == ["error", "pending", "success"]
    body = json.dumps({"groups": [{"summaries": [{"organization": {"name": "ACME", "ror": None}, "role": "r", "start": {"year": "2020"}, "end": None}]}]})
    people = spark.createDataFrame([(1, "https://orcid.org/0-1"), (2, None)], "id long, orcid string")
    profiles = spark.createDataFrame([("0-1", 200, body)], "key string, status int, body string")
    orgs = spark.createDataFrame([("o1", "acme", None)], "id string, name string, ror string")
    assert [(r["person_id"], r["organisation"], str(r["start"])) for r in P.employments(people, profiles, orgs).collect()] == [(1, "o1", "2020-01-01")]


def test_diverse_choice(spark):
    import random

    from quarrymill.operators.keywords import diverse, ngrams

    rng = random.Random(2)
    cands = []
    for i in range(12):
        v = [rng.gauss(0, 1) for _ in range(4)]
        n = math.sqrt(sum(x * x for x in v))
        cands.append((f"t{i}", rng.random(), [x / n for x in v]))
    chosen = []
    for _ in range(5):
        worth = lambda c: 0.3 * c[1] - 0.7 * max([sum(a * b for a, b in zip(c[2], x[2], strict=True)) for x in chosen], default=0.0)
        chosen.append(max((c for c in cands if c not in chosen), key=worth))
    df = spark.createDataFrame([(cands,)], "x array<struct<term:string,relevance:double,v:array<double>>>")
    assert df.select(diverse(F.col("x"), 5, 0.7)).first()[0] == [c[0] for c in chosen]
    assert df.select(F.size(diverse(F.col("x"), 20, 0.7))).first()[0] == 12
    assert spark.range(1).select(ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, 2)).first()[0] == ["a", "b", "c", "a b", "b c"]
    assert spark.range(1).select(ngrams(F.array().cast("array<string>"), 1, 4)).first()[0] == []


def test_stream(spark, tmp_path):
    from quarrymill.streaming.ledger import augment_stream

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    derive = lambda d: d.select(F.col("id").cast("string").alias("record_id"), F.lit("len").alias("property"), F.length("t").cast("string").alias("value"))
    spark.createDataFrame([(1, "a"), (2, "bb"), (2, "bb")], "id long, t string").write.mode("append").parquet(src)
    schema = "id long, t string"
    augment_stream(spark, src, schema, out, "id", "p", derive).awaitTermination()
    spark.createDataFrame([(2, "bb"), (3, "ccc")], schema).write.mode("append").parquet(src)
    augment_stream(spark, src, schema, out, "id", "p", derive).awaitTermination()
    rows = spark.read.parquet(f"{out}/augments").collect()
    assert sorted((r["record_id"], r["value"]) for r in rows) == [("1", "1"), ("2", "2"), ("3", "3")]
    assert spark.read.parquet(f"{out}/status").count() == 3


def test_files_of_answers(spark):
    # fixed values: the shape of each repository's answer
    cases = {
        ("https://zenodo.org/records/5", '{"files":[{"links":{"self":"https://a/1"}},{"links":{}}]}'): ["https://a/1"],
        ("https://datadryad.org/dataset/doi:10.1/x", '{"_embedded":{"files":[{"_links":{"self":{"href":"/f/2"}}}]}}'): ["/f/2"],
        ("https://dataverse.nl/dataset.xhtml?persistentId=doi:10.1/y", '{"data":{"latestVersion":{"files":[{"dataFile":{"id":7}}]}}}'): ["https://dataverse.nl/api/access/datafile/7"],
        ("https://zenodo.org/records/5", "{broken"): [], ("https://other.org/1", "{}"): [],
    }
    rows = spark.createDataFrame([(u, a) for u, a in cases], "u string, a string")
    got = {(r["u"], r["a"]): r["f"] for r in rows.select("u", "a", DL.files_of_answer(F.col("u"), F.col("a")).alias("f")).collect()}
    assert got == cases
    assert one(spark, "https://dataverse.nl/dataset.xhtml?persistentId=doi:10.1/y", DL.answer_address) == "https://dataverse.nl/api/datasets/:persistentId/?persistentId=doi:10.1/y"


def test_fuzzy_scores_equal_the_column_expression(spark):
    from quarrymill.functions import text as T
    from quarrymill.operators import matching as M

    names = ["soil water", "water soils", "soil", "Boden", "böden", "a" * 70, "ab" * 40, "x"]
    keys = spark.createDataFrame([(n,) for n in names], "key string")
    labels = spark.createDataFrame([(str(i), i, n) for i, n in enumerate(names)], "concept string, pos int, label string")
    got = {(r["key"], r["label"]): r["score"] for r in M.fuzzy_scores(keys, labels, 60).collect()}
    both = keys.crossJoin(labels).withColumn("score", T.similarity(F.col("key"), F.col("label"))).where("score >= 60")
    assert got == {(r["key"], r["label"]): r["score"] for r in both.collect()} and len(got) > len(names)


def test_countries_of_a_file(spark):
    square = [[[0.0, 50.0], [10.0, 50.0], [10.0, 60.0], [0.0, 60.0], [0.0, 50.0]]]
    wide = [[[30.0, 50.0], [120.0, 50.0], [120.0, 70.0], [30.0, 70.0], [30.0, 50.0]], [[130.0, 50.0], [140.0, 50.0], [135.0, 60.0], [130.0, 50.0]]]
    rows = spark.createDataFrame([("Russian Federation", wide), ("Moldova, Republic of", square), ("France", square), ("Canada", square)], "name string, rings array<array<array<double>>>")
    got = {r["name"]: r for r in R.countries(rows).collect()}
    assert {k: (r["canonical"], r["is_eu"], r["w"], r["e"], len(r["rings"])) for k, r in got.items()} == {
        "Russian Federation": ("russia", True, 30.0, 60.0, 1), "Moldova, Republic of": ("moldova", True, 0.0, 10.0, 1), "France": ("france", True, 0.0, 10.0, 1), "Canada": (None, False, 0.0, 10.0, 1),
    }


def test_writers_can_run_twice(spark, tmp_path):
    rows = spark.createDataFrame([("a", "p", "1"), ("b", "p", "2")], "record_id string, process string, value string")
    status = W.status_of(rows, "record_id", "p")
    for _ in range(2):
        W.augments(rows, status, str(tmp_path), "one")
    W.augments(rows.limit(1), status.limit(1), str(tmp_path), "two")
    assert [spark.read.parquet(str(tmp_path / n)).count() for n in ("augments", "status")] == [3, 3]
    items = spark.createDataFrame([("i", "doi", "S", "h1", "t"), ("i", "doi", "S", "h1", "u"), ("j", "uri", "S", "h2", None)], "identifier string, identifiertype string, source string, hash string, title string")
    for part in (items, items, items.withColumn("hash", F.lit("h3"))):
        W.insert_records(part, str(tmp_path / "harvest"))
    assert [spark.read.parquet(str(tmp_path / "harvest" / n)).count() for n in ("items", "item_duplicates")] == [4, 4]
    for name in ("Zenodo", "ZENODO", "other"):
        W.add_sources(spark.createDataFrame([(name, "u", None, "t")], "name string, url string, filter string, type string"), str(tmp_path / "sources"))
    assert sorted(r["name"] for r in spark.read.parquet(str(tmp_path / "sources")).collect()) == ["OTHER", "ZENODO"]


def test_chunks_match_a_loop(spark):
    import random
    import re

    rng = random.Random(4)
    texts = ["", "One.", "No end"] + [" ".join("".join(rng.choice("abcÄ") for _ in range(rng.randint(1, 9))).capitalize() + rng.choice(["", ".", "!", "?"]) for _ in range(rng.randint(1, 80))) for _ in range(60)]

    def by_hand(text, low, high):
        done, now = [], ""
        for t in re.split(r"(?<=[.!?])\s+(?=[A-ZÄÖÜ])", text):
            joined = f"{now} {t}" if now else t
            if not now or len(now) < low and len(joined) <= high:
                now = joined
            else:
                done.append(now)
                now = t
        if now and len(now) < low and done:
            done[-1] += f" {now}"
        elif now:
            done.append(now)
        return done

    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", X.chunks(F.col("t"), 30, 90).alias("c")).collect()
    assert {r["k"]: r["c"] for r in rows} == {k: by_hand(t, 30, 90) for k, t in enumerate(texts)}
