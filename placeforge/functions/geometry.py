"""Geometry columns over ``struct<gtype, parts>`` (parts -> rings -> points).

A POINT has one part with one ring of one point; a line is a ring that need not close; a polygon part
is its shell followed by its holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeforge.schema import GEOMETRY

EARTH_RADIUS = 6378137.0  # radius of EPSG:3857
POLYGONAL = ("POLYGON", "MULTIPOLYGON")
LINEAR = ("LINESTRING", "MULTILINESTRING")
POINTS = ("POINT", "MULTIPOINT")


# ---- construction ----

def point_xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(gtype: Column, parts: Column) -> Column:
    return F.struct(gtype.alias("gtype"), parts.alias("parts")).cast(GEOMETRY)


def make_point(x: Column, y: Column) -> Column:
    return geometry(F.lit("POINT"), F.array(F.array(F.array(point_xy(x, y)))))


def make_line(points: Column) -> Column:
    return geometry(F.lit("LINESTRING"), F.array(F.array(points)))


def make_box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    ring = F.array(
        point_xy(minx, miny), point_xy(maxx, miny), point_xy(maxx, maxy), point_xy(minx, maxy), point_xy(minx, miny)
    )
    return geometry(F.lit("POLYGON"), F.array(F.array(ring)))


# ---- parts and measures ----

def rings(geom: Column) -> Column:
    return F.flatten(geom["parts"])


def points(geom: Column) -> Column:
    return F.flatten(rings(geom))


def num_points(geom: Column) -> Column:
    return F.aggregate(rings(geom), F.lit(0), lambda n, ring: n + F.size(ring))


def num_parts(geom: Column) -> Column:
    return F.size(geom["parts"])


def first_point(geom: Column) -> Column:
    return geom["parts"][0][0][0]


def bounds(geom: Column) -> dict[str, Column]:
    xs, ys = points(geom)["x"], points(geom)["y"]
    return {
        "minx": F.array_min(xs), "miny": F.array_min(ys), "maxx": F.array_max(xs), "maxy": F.array_max(ys),
    }


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _steps(ring: Column, f) -> Column:
    """``f(p, q)`` over consecutive points of a ring."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), f)


def _segment(p: Column, q: Column) -> Column:
    return F.struct(p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1"))


def ring_segments(ring: Column) -> Column:
    """Segments of a ring or line; one of length zero for a single point."""
    return F.when(F.size(ring) == 1, F.array(_segment(ring[0], ring[0]))).otherwise(_steps(ring, _segment))


def segments(geom: Column) -> Column:
    return F.flatten(F.transform(rings(geom), ring_segments))


def length(geom: Column) -> Column:
    """Planar length of the lines or rings; 0 for points."""
    return _sum(
        F.transform(
            segments(geom),
            lambda s: F.sqrt(F.pow(s["x1"] - s["x0"], F.lit(2)) + F.pow(s["y1"] - s["y0"], F.lit(2))),
        )
    )


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area; offsets from the first point keep small rings exact."""
    x0, y0 = ring[0]["x"], ring[0]["y"]
    crosses = _steps(ring, lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0))
    return F.abs(_sum(crosses)) / 2


def _polygon_measure(geom: Column, of_ring) -> Column:
    """Sum over parts of shell minus holes; 0 unless polygonal."""
    per_part = F.transform(
        geom["parts"],
        lambda part: F.lit(2.0) * of_ring(part[0]) - _sum(F.transform(part, of_ring)),
    )
    return F.when(geom["gtype"].isin(*POLYGONAL), _sum(per_part)).otherwise(F.lit(0.0))


def area(geom: Column) -> Column:
    """Planar area in square units of the coordinates (square degrees)."""
    return _polygon_measure(geom, ring_area)


# ---- projection ----

def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(EARTH_RADIUS)


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(EARTH_RADIUS)


def map_points(geom: Column, f) -> Column:
    """Geometry with ``f(point)`` in place of every point."""
    moved = F.transform(geom["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, f)))
    return geometry(geom["gtype"], moved)


def to_mercator(geom: Column) -> Column:
    """EPSG:4326 to EPSG:3857."""
    return map_points(geom, lambda p: point_xy(mercator_x(p["x"]), mercator_y(p["y"])))


def degrees_of_meters(meters: Column, lat: Column) -> Column:
    """Metres along the meridian at a latitude, in degrees (curvature of the ellipsoid)."""
    a, b = 6378.137, 6356.7523
    lat_r = F.radians(lat)
    squares = F.pow(a * F.cos(lat_r), F.lit(2)) + F.pow(b * F.sin(lat_r), F.lit(2))
    radius_km = F.lit((a * b) ** 2) / F.pow(squares, F.lit(1.5))
    return meters / (radius_km * 1000 * F.lit(2 * math.pi / 360))


# ---- predicates against one constant area ----

Ring = list[tuple[float, float]]


def _literal_points(ring: Ring) -> Column:
    return F.array(*[point_xy(F.lit(float(x)), F.lit(float(y))) for x, y in ring])


def _cross(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _on_segment(s: Column, p: Column) -> Column:
    return (
        (_cross(s["x0"], s["y0"], s["x1"], s["y1"], p["x"], p["y"]) == 0)
        & p["x"].between(F.least(s["x0"], s["x1"]), F.greatest(s["x0"], s["x1"]))
        & p["y"].between(F.least(s["y0"], s["y1"]), F.greatest(s["y0"], s["y1"]))
    )


def _ray_hits(s: Column, p: Column) -> Column:
    """Does the ray from ``p`` to the right cross the segment (half-open in y)?"""
    straddles = (s["y0"] > p["y"]) != (s["y1"] > p["y"])
    x_at = s["x0"] + (p["y"] - s["y0"]) / F.nullif(s["y1"] - s["y0"], F.lit(0.0)) * (s["x1"] - s["x0"])
    return straddles & F.coalesce(p["x"] < x_at, F.lit(False))


def covers_point(segs: Column, p: Column) -> Column:
    """Is the point inside the rings given as segments, or on them?"""
    hits = F.aggregate(segs, F.lit(0), lambda n, s: n + _ray_hits(s, p).cast("int"))
    return ((hits % 2) == 1) | F.exists(segs, lambda s: _on_segment(s, p))


def segments_touch(s: Column, e: Column) -> Column:
    """Do two closed segments share a point?"""
    d1 = F.sign(_cross(s["x0"], s["y0"], s["x1"], s["y1"], e["x0"], e["y0"]))
    d2 = F.sign(_cross(s["x0"], s["y0"], s["x1"], s["y1"], e["x1"], e["y1"]))
    d3 = F.sign(_cross(e["x0"], e["y0"], e["x1"], e["y1"], s["x0"], s["y0"]))
    d4 = F.sign(_cross(e["x0"], e["y0"], e["x1"], e["y1"], s["x1"], s["y1"]))
    boxes = (
        (F.least(s["x0"], s["x1"]) <= F.greatest(e["x0"], e["x1"]))
        & (F.least(e["x0"], e["x1"]) <= F.greatest(s["x0"], s["x1"]))
        & (F.least(s["y0"], s["y1"]) <= F.greatest(e["y0"], e["y1"]))
        & (F.least(e["y0"], e["y1"]) <= F.greatest(s["y0"], s["y1"]))
    )
    return boxes & (d1 * d2 <= 0) & (d3 * d4 <= 0)


class Area:
    """A constant polygon: a shell and optional holes, as lists of (lon, lat)."""

    def __init__(self, shell: Ring, holes: list[Ring] | None = None):
        self.rings = [self._closed(r) for r in [shell, *(holes or [])]]
        xs, ys = zip(*self.rings[0])
        self.minx, self.miny, self.maxx, self.maxy = min(xs), min(ys), max(xs), max(ys)

    @staticmethod
    def _closed(ring: Ring) -> Ring:
        ring = [(float(x), float(y)) for x, y in ring]
        return ring if ring[0] == ring[-1] else [*ring, ring[0]]

    def signed_triangles(self) -> list[tuple[int, Ring]]:
        """Triangles whose signed sum covers the polygon once: fans from each ring's first point."""
        found = []
        for number, ring in enumerate(self.rings):
            ox, oy = ring[0]
            fan = [(_cross(ox, oy, *p, *q), p, q) for p, q in zip(ring[1:-2], ring[2:-1])]
            turn = math.copysign(1, sum(c for c, _, _ in fan)) * (1 if number == 0 else -1)
            found += [
                (int(math.copysign(1, c) * turn), [(ox, oy), p, q] if c > 0 else [(ox, oy), q, p])
                for c, p, q in fan
                if c != 0
            ]
        return found

    def is_convex(self) -> bool:
        """One ring that turns one way only, and once around."""
        if len(self.rings) != 1:
            return False
        ring = self.rings[0][:-1]
        n = len(ring)
        turns = [_cross(*ring[i], *ring[(i + 1) % n], *ring[(i + 2) % n]) for i in range(n)]
        if any(t < 0 for t in turns) and any(t > 0 for t in turns):
            return False
        angles = [math.atan2(ring[(i + 1) % n][1] - ring[i][1], ring[(i + 1) % n][0] - ring[i][0]) for i in range(n)]
        around = sum(math.remainder(angles[(i + 1) % n] - angles[i], 2 * math.pi) for i in range(n))
        return abs(abs(around) - 2 * math.pi) < 1e-6

    def convex_pieces(self) -> list[tuple[int, Ring]]:
        """Signed convex pieces, counter-clockwise."""
        if not self.is_convex():
            return self.signed_triangles()
        ring = self.rings[0][:-1]
        turn = sum(_cross(*ring[0], *p, *q) for p, q in zip(ring[1:], ring[2:]))
        return [(1, ring if turn > 0 else ring[::-1])]

    def segments(self) -> Column:
        found = [(*p, *q) for ring in self.rings for p, q in zip(ring, ring[1:])]
        return F.array(
            *[F.struct(*[F.lit(v).alias(n) for v, n in zip(s, ("x0", "y0", "x1", "y1"))]) for s in found]
        )

    def corner(self) -> Column:
        return point_xy(*map(F.lit, self.rings[0][0]))


def _literal_edges(convex: Ring) -> Column:
    return F.array(
        *[
            F.struct(*[F.lit(float(v)).alias(n) for v, n in zip((*p, *q), ("ax", "ay", "bx", "by"))])
            for p, q in zip(convex, [*convex[1:], convex[0]])
        ]
    )


def _clip_ring(ring: Column, edges: Column) -> Column:
    """Ring cut by each half-plane of a counter-clockwise convex polygon, given by its edges, in turn."""

    def cut(acc: Column, e: Column) -> Column:
        def side(p: Column) -> Column:
            return _cross(e["ax"], e["ay"], e["bx"], e["by"], p["x"], p["y"])

        def kept(p: Column, q: Column) -> Column:
            t = side(p) / F.nullif(side(p) - side(q), F.lit(0.0))
            crossing = point_xy(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))
            crosses = ((side(p) > 0) & (side(q) < 0)) | ((side(p) < 0) & (side(q) > 0))
            nothing = F.slice(F.array(p), F.lit(1), F.lit(0))
            return F.concat(
                F.when(crosses, F.array(crossing)).otherwise(nothing),
                F.when(side(q) >= 0, F.array(q)).otherwise(nothing),
            )

        # the open ring: each point follows the one before it, the first follows the last
        previous = F.concat(F.slice(acc, F.lit(-1), F.lit(1)), F.slice(acc, F.lit(1), F.size(acc) - 1))
        cut_ring = F.flatten(F.zip_with(previous, acc, kept))
        return F.when(F.size(acc) == 0, acc).otherwise(cut_ring)

    open_ring = F.slice(ring, F.lit(1), F.size(ring) - 1)
    return F.aggregate(edges, open_ring, cut)


def near_box(geom: Column, area_: Area) -> Column:
    box = bounds(geom)
    return (
        (box["minx"] <= area_.maxx) & (box["maxx"] >= area_.minx)
        & (box["miny"] <= area_.maxy) & (box["maxy"] >= area_.miny)
    )


def intersection_area(geom: Column, area_: Area) -> Column:
    """Area of the part of a polygonal geometry inside the constant area; 0 for points and lines.

    The area's convex pieces are one constant array, so the plan is as large for any number of corners. Boxes come
    first: what is far off is 0, what lies within a convex area counts whole, and pieces are only cut where the box meets them.
    """
    pieces = area_.convex_pieces()
    parts = F.array(*[F.struct(F.lit(float(sign)).alias("sign"), _literal_edges(piece).alias("edges")) for sign, piece in pieces])

    def clipped_area(edges: Column):
        def of_ring(ring: Column) -> Column:
            # close the clipped ring again; an empty one has area 0
            return F.coalesce(
                F.element_at(
                    F.transform(
                        F.array(_clip_ring(ring, edges)),
                        lambda r: F.when(F.size(r) > 2, ring_area(F.concat(r, F.slice(r, F.lit(1), F.lit(1))))),
                    ),
                    1,
                ),
                F.lit(0.0),
            )

        return of_ring

    box = bounds(geom)
    corners = F.array(*[point_xy(box[x], box[y]) for x in ("minx", "maxx") for y in ("miny", "maxy")])

    def met(held: Column):
        """Not the pieces that have the whole box beyond one of their edges."""
        beyond = lambda e: F.forall(held, lambda c: _cross(e["ax"], e["ay"], e["bx"], e["by"], c["x"], c["y"]) < 0)
        return lambda p: ~F.coalesce(F.exists(p["edges"], beyond), F.lit(False))

    # the corners are worked out once, as the only item of an array
    near = F.element_at(F.transform(F.array(corners), lambda held: F.filter(parts, met(held))), 1)
    clipped = F.aggregate(near, F.lit(0.0), lambda acc, p: acc + p["sign"] * _polygon_measure(geom, clipped_area(p["edges"])))
    found = F.when(~geom["gtype"].isin(*POLYGONAL) | ~near_box(geom, area_), F.lit(0.0))
    if len(pieces) == 1:
        (_, ring) = pieces[0]
        edges = _literal_edges(ring)
        within = F.forall(corners, lambda c: F.forall(edges, lambda e: _cross(e["ax"], e["ay"], e["bx"], e["by"], c["x"], c["y"]) >= 0))
        found = found.when(within, area(geom))
    return found.otherwise(clipped)


def intersects(geom: Column, area_: Area) -> Column:
    """Do geometry and area share a point? Touching counts."""
    own, others = segments(geom), area_.segments()
    near = near_box(geom, area_)
    inside = F.exists(points(geom), lambda p: covers_point(others, p))
    crossing = F.exists(own, lambda s: F.exists(others, lambda e: segments_touch(s, e)))
    around = geom["gtype"].isin(*POLYGONAL) & covers_point(own, area_.corner())
    return near & (inside | crossing | around)


def pick_geometry(geoms: Column, importances: Column) -> Column:
    """Of parallel arrays, the most important geometry of more than one point, else the most important.

    The first of equals is taken.
    """
    placed = F.transform(
        F.arrays_zip(geoms.alias("g"), importances.alias("i")),
        lambda p, n: F.struct(
            (num_points(p["g"]) > 1).alias("shaped"), p["i"].alias("i"), (-n).alias("n"), p["g"].alias("g")
        ),
    )
    return F.array_max(placed)["g"]


def near_area(area_: Area) -> Column:
    """Bounding-box test on the stored box columns; reaches the parquet scan."""
    return (
        (F.col("minx") <= area_.maxx) & (F.col("maxx") >= area_.minx)
        & (F.col("miny") <= area_.maxy) & (F.col("maxy") >= area_.miny)
    )


def in_working_area(geom: Column, own_area: Column, area_: Area) -> Column:
    """Touches the area and, when polygonal, has at least half of itself inside."""
    touches = intersects(geom, area_)
    share = F.try_divide(intersection_area(geom, area_), own_area)
    # the share is only worked out for polygons that touch
    return F.when(touches & geom["gtype"].isin(*POLYGONAL), share >= 0.5).otherwise(touches)
