"""Bounding boxes and the equal-area projection of Europe as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ETRS89 / LAEA Europe projection (EPSG:3035) on the GRS 80 ellipsoid.
A, FLATTENING = 6378137.0, 1 / 298.257222101
LAT0, LON0, EAST0, NORTH0 = math.radians(52), math.radians(10), 4321000.0, 3210000.0
E2 = FLATTENING * (2 - FLATTENING)
E1 = math.sqrt(E2)


def _q(sin: float) -> float:
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - math.log((1 - E1 * sin) / (1 + E1 * sin)) / (2 * E1))


QP = _q(1.0)
BETA0 = math.asin(_q(math.sin(LAT0)) / QP)
RQ = A * math.sqrt(QP / 2)
D = A * math.cos(LAT0) / math.sqrt(1 - E2 * math.sin(LAT0) ** 2) / (RQ * math.cos(BETA0))


def parse_bbox(x: Column) -> Column:
    """struct(w, s, e, n) of a list or tuple of four numbers as text; NULL if malformed."""
    a = F.from_json(F.translate(x, "()", "[]"), "array<double>")
    four = (F.size(a) == 4) & ~F.exists(a, lambda v: v.isNull())
    return F.when(four, F.struct(*[F.get(a, k).alias(n) for k, n in enumerate("wsen")]))


def is_wgs84(b: Column) -> Column:
    """Degrees in range, east not before west, north not below south."""
    ok = b["w"].between(-180, 180) & b["e"].between(-180, 180) & b["s"].between(-90, 90) & b["n"].between(-90, 90)
    return F.coalesce(ok & (b["e"] >= b["w"]) & (b["n"] >= b["s"]), F.lit(False))


def shape(b: Column) -> Column:
    flat, thin = b["n"] == b["s"], b["e"] == b["w"]
    return F.when(flat & thin, "point").when(flat | thin, "line").otherwise("polygon")


def overlaps(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Closed rectangles that share a point."""
    return (a["e"] >= b["w"]) & (a["w"] <= b["e"]) & (a["n"] >= b["s"]) & (a["s"] <= b["n"])


def laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    sin = F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (sin / (1 - F.lit(E2) * sin * sin) - F.log((1 - F.lit(E1) * sin) / (1 + F.lit(E1) * sin)) / (2 * E1))
    beta = F.asin(F.greatest(F.least(q / QP, F.lit(1.0)), F.lit(-1.0)))
    turn = F.radians(lon) - LON0
    b = RQ * F.sqrt(F.lit(2.0) / (1 + math.sin(BETA0) * F.sin(beta) + math.cos(BETA0) * F.cos(beta) * F.cos(turn)))
    east = EAST0 + b * D * F.cos(beta) * F.sin(turn)
    north = NORTH0 + b / D * (math.cos(BETA0) * F.sin(beta) - math.sin(BETA0) * F.cos(beta) * F.cos(turn))
    return east, north


def bbox_km2(w: Column, s: Column, e: Column, n: Column) -> Column:
    """Area of a box's four projected corners, in square kilometres."""
    corners = [laea(w, s), laea(e, s), laea(e, n), laea(w, n)]
    twice = F.lit(0.0)
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1], strict=True):
        twice = twice + x1 * y2 - x2 * y1
    return F.abs(twice) / 2e6


def overlap_degrees(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Area that two rectangles share, in square degrees."""
    x = F.least(a["e"], b["e"]) - F.greatest(a["w"], b["w"])
    y = F.least(a["n"], b["n"]) - F.greatest(a["s"], b["s"])
    return F.greatest(x, F.lit(0.0)) * F.greatest(y, F.lit(0.0))


def reorder(south: Column, north: Column, west: Column, east: Column) -> Column:
    """A geocoder's (south, north, west, east) as [west, south, east, north], north never below south."""
    return F.array(west, F.least(south, north), east, F.greatest(south, north))


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def ring_points(ring: Column) -> Column:
    """[[lon, lat], ...] as points, without the closing repeat of the first."""
    points = F.transform(ring, lambda p: _point(F.get(p, 0), F.get(p, 1)))
    closed = (F.size(ring) > 1) & (F.get(points, 0) == F.element_at(points, -1))
    return F.when(closed, F.slice(points, F.lit(1), F.size(points) - 1)).otherwise(points)


def _clip(points: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """A polygon's part on one side of a line across ``axis``: each edge gives its end, its crossing, both or nothing."""
    from .text import let

    other = "y" if axis == "x" else "x"
    inside = lambda p: p[axis] >= bound if keep_above else p[axis] <= bound

    def cross(a: Column, b: Column) -> Column:
        t = (bound - a[axis]) / (b[axis] - a[axis])
        along = a[other] + t * (b[other] - a[other])
        return _point(bound, along) if axis == "x" else _point(along, bound)

    def edges(ps: Column) -> Column:
        def one(a: Column, i: Column) -> Column:
            b = F.get(ps, (i + 1) % F.size(ps))
            none = F.slice(ps, F.lit(1), F.lit(0))
            return F.when(inside(a) & inside(b), F.array(b)).when(inside(a), F.array(cross(a, b))).when(inside(b), F.array(cross(a, b), b)).otherwise(none)

        return F.flatten(F.transform(ps, one))

    return let(points, edges)


def clip_to_box(points: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """The part of a ring (points) inside a box."""
    out = points
    for axis, bound, above in (("x", w, True), ("x", e, False), ("y", s, True), ("y", n, False)):
        out = _clip(out, axis, bound.cast("double"), above)
    return out


def twice_area(points: Column) -> Column:
    """Twice the signed area of a ring of points."""
    from .text import let

    def total(ps: Column) -> Column:
        def add(sum_: Column, i: Column) -> Column:
            a, b = F.get(ps, i), F.get(ps, (i + 1) % F.size(ps))
            return sum_ + a["x"] * b["y"] - b["x"] * a["y"]

        return F.when(F.size(ps) < 3, 0.0).otherwise(F.aggregate(F.sequence(F.lit(0), F.size(ps) - 1), F.lit(0.0), add))

    return let(points, total)


def projected(points: Column) -> Column:
    return F.transform(points, lambda p: _point(*laea(p["x"], p["y"])))


def overlap_km2(rings: Column, w: Column, s: Column, e: Column, n: Column) -> Column:
    """Area that a box shares with a geometry's rings, in square kilometres of the projection.

    Outer rings and holes have opposite turns, as GeoJSON asks, so their signed areas add up.
    """
    sums = F.aggregate(rings, F.lit(0.0), lambda t, r: t + twice_area(projected(clip_to_box(ring_points(r), w, s, e, n))))
    return F.abs(sums) / 2e6


def covers(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a geometry: an odd number of its edges cross the ray to the east."""
    from .text import let

    def crossings(ps: Column) -> Column:
        def hit(a: Column, i: Column) -> Column:
            b = F.get(ps, (i + 1) % F.size(ps))
            across = (a["y"] > y) != (b["y"] > y)
            return F.when(across & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]), 1).otherwise(0)

        return F.aggregate(F.transform(ps, hit), F.lit(0), lambda t, v: t + v)

    return F.aggregate(rings, F.lit(0), lambda t, r: t + let(ring_points(r), crossings)) % 2 == 1
