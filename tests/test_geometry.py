"""Polygons against boxes and points, and cached lookups."""

import json
import random

from pyspark.sql import functions as F

from quarrymill.functions import geo as G
from quarrymill.plans import lookups as K

RING = "array<array<array<double>>>"


def area_by_hand(points, w, s, e, n, steps=400):
    """Share of a fine grid of the box that lies in the polygon, times the box."""

    def inside(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    hits = sum(inside(w + (e - w) * (i + 0.5) / steps, s + (n - s) * (j + 0.5) / steps) for i in range(steps) for j in range(steps))
    return hits / steps**2 * (e - w) * (n - s)


def test_clipping(spark):
    shapes = [[(0, 0), (10, 0), (5, 8)], [(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)], [(2, 2), (3, 2), (3, 3), (2, 3)]]
    boxes = [(1, 1, 6, 5), (-5, -5, 20, 20), (20, 20, 21, 21), (4, 0, 7, 9)]
    rows = [([list(map(float, p)) for p in ps + ps[:1]], *map(float, b)) for ps in shapes for b in boxes]
    df = spark.createDataFrame(rows, "r array<array<double>>, w double, s double, e double, n double")
    clipped = G.clip_to_box(G.ring_points(F.col("r")), *[F.col(c) for c in "wsen"])
    got = [r[0] for r in df.select((F.abs(G.twice_area(clipped)) / 2).alias("a")).collect()]
    want = [area_by_hand(ps, *b) for ps in shapes for b in boxes]
    assert all(abs(a - b) < 0.15 for a, b in zip(got, want, strict=True)), (got, want)


def test_geometry_with_a_hole(spark):
    outer, hole = [[0.0, 45.0], [10.0, 45.0], [10.0, 50.0], [0.0, 50.0], [0.0, 45.0]], [[4.0, 47.0], [4.0, 48.0], [6.0, 48.0], [6.0, 47.0], [4.0, 47.0]]
    df = spark.createDataFrame([([outer, hole], 5.0, 47.5), ([outer, hole], 1.0, 46.0), ([outer, hole], 11.0, 46.0)], f"g {RING}, x double, y double")
    assert [r[0] for r in df.select(G.covers(F.col("g"), F.col("x"), F.col("y"))).collect()] == [False, True, False]
    box = [F.lit(float(v)) for v in (0, 45, 10, 50)]
    whole = df.select(G.overlap_km2(F.col("g"), *box).alias("a"), G.bbox_km2(*box).alias("b"), G.bbox_km2(*[F.lit(float(v)) for v in (4, 47, 6, 48)]).alias("h")).first()
    assert abs(whole["a"] - (whole["b"] - whole["h"])) < 1


def test_random_points(spark):
    rng = random.Random(3)
    ring = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [5.0, 3.0], [0.0, 10.0]]
    points = [(rng.uniform(-1, 11), rng.uniform(-1, 11)) for _ in range(200)]
    df = spark.createDataFrame([([ring], x, y) for x, y in points], f"g {RING}, x double, y double")
    got = [r[0] for r in df.select(G.covers(F.col("g"), F.col("x"), F.col("y"))).collect()]

    def inside(x, y):
        return 0 <= x <= 10 and y >= 0 and (y <= 10 - 1.4 * x if x <= 5 else y <= 3 + 1.4 * (x - 5))

    assert got == [inside(x, y) for x, y in points]


def test_polygon_countries(spark):
    from quarrymill.operators import spatial as S

    tri = [[[0.0, 45.0], [10.0, 45.0], [0.0, 50.0], [0.0, 45.0]]]
    rest = [[[10.0, 45.0], [10.0, 50.0], [0.0, 50.0], [10.0, 45.0]]]
    land = spark.createDataFrame([("A", True, tri, 0.0, 45.0, 10.0, 50.0), ("B", True, rest, 0.0, 45.0, 10.0, 50.0)], "name string, is_eu boolean, rings array<array<array<double>>>, w double, s double, e double, n double")
    boxes = spark.createDataFrame([(1, 0.5, 45.5, 1.5, 46.5), (2, 8.5, 48.5, 9.5, 49.5), (3, 0.0, 45.0, 10.0, 50.0), (4, 1.0, 46.0, 1.0, 46.0), (5, 9.0, 49.0, 9.0, 49.0)], "id int, w double, s double, e double, n double")
    rows = {r["id"]: r for r in S.classify(boxes, land, "id").collect()}
    assert {k: (r["classification"].split("_")[0], r["top"]) for k, r in rows.items()} == {1: ("single", "A"), 2: ("single", "B"), 3: ("single", "A"), 4: ("single", "A"), 5: ("single", "B")}
    shares = S.shares(S.box_hits(boxes.where("id = 3"), land), "id").first()["countries"]
    assert abs(shares["A"] - 0.516) < 0.01 and abs(sum(shares.values()) - 1) < 1e-3


def test_lookups(spark):
    works = json.dumps({"message": {"title": ["T"], "type": "dataset", "issued": {"date-parts": [[2020, 3]]}, "reference": [{"DOI": "10.1/a"}, {"doi": " 10.1/b "}, {"DOI": "10.1/a"}, {}]}})
    cache = spark.createDataFrame([("k", 200, works), ("gone", 404, None)], "key string, status int, body string")
    rows = spark.createDataFrame([(1, "k"), (2, "new"), (3, None), (4, "new"), (5, "gone")], "id int, doi string")
    found, missing = K.resolve(rows, "doi", cache)
    assert sorted(r["id"] for r in found.collect()) == [1, 5] and [r["key"] for r in missing.collect()] == ["new"]
    x = found.where("id = 1").select(K.crossref(F.col("body")).alias("x")).first()["x"]
    assert (x["title"], x["issued"], x["references"]) == ("T", "2020-03", ["10.1/a", "10.1/b"])
    one = lambda body, f: spark.createDataFrame([(body,)], "b string").select(f(F.col("b")).alias("x")).first()["x"]
    assert one("{bad", K.crossref) is None and one('{"items": []}', K.organisation) is None
    org = one(json.dumps({"items": [{"id": "https://ror.org/1", "name": "N", "addresses": [{"city": "C"}], "country": {"country_name": "L"}}]}), K.organisation)
    assert tuple(org) == ("https://ror.org/1", "N", "C", "L")
    places = spark.createDataFrame([("paris", 200, '[{"boundingbox": ["48", "49", "2", "3"]}]'), ("rome", 200, '[{"boundingbox": ["42.5", "41", "12", "13"]}]'), ("x", 404, None)], "key string, status int, body string")
    recs = spark.createDataFrame([(1, "Paris, Rome"), (2, "x"), (3, None)], "id int, spatial string")
    assert [tuple(r) for r in K.geocoded(recs, "id", "spatial", places).collect()] == [(1, 2.0, 41.0, 13.0, 49.0)]
    v = one(json.dumps({"items": [{"snippet": {"title": "P", "resourceId": {"videoId": "a"}}}, {"snippet": {"title": "Q", "resourceId": {"videoId": "b"}}}]}), K.video)
    assert v["name"] == "P" and v["parts"] == ["a", "b"]
