"""Overlaps as geometries: by hand, and by area against the half-plane clipping."""

import math
import random

import pytest
from pyspark.sql import functions as F

from placeforge.functions import formats, geometry
from placeforge.functions.geometry import Area
from placeforge.operators import kernels, overlay

SQUARE = Area([(0, 0), (4, 0), (4, 4), (0, 4)])
FRAME = Area([(0, 0), (8, 0), (8, 8), (0, 8)], [[(3, 3), (5, 3), (5, 5), (3, 5)]])
ELL = Area([(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)])


def overlaps(spark, area, *shapes):
    rows = spark.createDataFrame(list(enumerate(shapes)), "n int, t string").select("n", formats.from_ewkt(F.col("t")).alias("geometry"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)  # a column, not an expression
    found = rows.select("n", overlay.overlap(F.col("geometry"), area).alias("o"), geometry.intersection_area(F.col("geometry"), area).alias("area"))
    found = spark.createDataFrame(found.collect(), found.schema)
    found = found.select("n", "o", "area", geometry.area(F.col("o.geometry")).alias("own"), kernels.is_valid(F.col("o.geometry")).alias("valid"))
    return found.orderBy("n").collect()


def kinds(spark, area, *shapes):
    return [(r.o.kind, None if r.o.geometry is None else len(r.o.geometry.parts)) for r in overlaps(spark, area, *shapes)]


def test_kinds_of_polygons(spark):
    assert kinds(
        spark, SQUARE,
        "POLYGON((1 1,2 1,2 2,1 2,1 1))",  # within
        "POLYGON((-1 -1,9 -1,9 9,-1 9,-1 -1))",  # around
        "POLYGON((0 0,4 0,4 4,0 4,0 0))",  # the same
        "POLYGON((3 3,9 3,9 9,3 9,3 3))",  # across a corner
        "POLYGON((4 1,9 1,9 3,4 3,4 1))",  # along an edge, outside
        "POLYGON((0 1,1 1,1 3,0 3,0 1))",  # along an edge, inside
        "POLYGON((4 4,9 4,9 9,4 9,4 4))",  # at a corner
        "POLYGON((-1 1,-1 9,1 9,1 8,0 8,0 4,1 4,1 3,2 3,2 9,3 9,3 1,-1 1))",  # touches and crosses
        "POLYGON((1 -1,2 -1,2 1,3 1,3 -1,3.5 -1,3.5 2,1 2,1 -1))",  # two legs out, one part
        "POLYGON((1 -1,3.5 -1,3.5 2,3 2,3 -0.5,2 -0.5,2 2,1 2,1 -1))",  # two legs in
        "POLYGON((9 9,10 9,10 10,9 9))",  # apart
        "POLYGON((5 1,6 1,6 3,5 3,4 2,5 1))",  # a tip on an edge
    ) == [
        ("POLYGON", 1), ("POLYGON", 1), ("POLYGON", 1), ("POLYGON", 1), ("LINESTRING", 1), ("POLYGON", 1), ("POINT", 1),
        ("POLYGON", 1), ("POLYGON", 1), ("MULTIPOLYGON", 2), ("GEOMETRYCOLLECTION", None), ("POINT", 1),
    ]


def test_kinds_with_holes(spark):
    shapes = [
        "POLYGON((1 1,7 1,7 7,1 7,1 1))",  # the frame's hole stays
        "POLYGON((1 4,7 4,7 4.5,1 4.5,1 4))",  # parted by the hole
        "POLYGON((3 3,5 3,5 5,3 5,3 3))",  # fills the hole: shares its outline only
        "POLYGON((3.5 3.5,4.5 3.5,4.5 4.5,3.5 4.5,3.5 3.5))",  # in the hole
        "POLYGON((-1 -1,9 -1,9 9,-1 9,-1 -1),(3 3,5 3,5 5,3 5,3 3))",  # a hole as the frame's
        "POLYGON((-1 -1,9 -1,9 9,-1 9,-1 -1),(2 2,6 2,6 6,2 6,2 2))",  # a wider hole
        "POLYGON((-1 -1,9 -1,9 9,-1 9,-1 -1),(1 1,2 1,2 2,1 2,1 1))",  # another hole
    ]
    rows = overlaps(spark, FRAME, *shapes)
    assert [(r.o.kind, r.o.geometry and [len(p) for p in r.o.geometry.parts]) for r in rows] == [
        ("POLYGON", [2]), ("MULTIPOLYGON", [1, 1]), ("LINESTRING", [1]), ("GEOMETRYCOLLECTION", None), ("POLYGON", [2]), ("POLYGON", [2]), ("POLYGON", [3]),
    ]
    assert [r.own for r in rows] == pytest.approx([r.area for r in rows])
    assert all(r.valid for r in rows if r.o.geometry is not None)


def test_kinds_of_lines_and_points(spark):
    assert kinds(
        spark, ELL,
        "LINESTRING(1 1,5 1)", "LINESTRING(-1 1,9 1)", "LINESTRING(1 5,5 1)", "LINESTRING(4 4,2 2,5 5)", "LINESTRING(2 3,2 5)",
        "LINESTRING(-1 6,9 6)", "LINESTRING(-1 3,1 3,3 3,3 1,3 -1)", "LINESTRING(7 0,6 1,7 2)", "LINESTRING(3 3,4 4)", "LINESTRING(4 3,2 3,2 4,4 4,4 2)",
        "POINT(1 1)", "POINT(6 1)", "POINT(4 4)",
    ) == [
        ("LINESTRING", 1), ("LINESTRING", 1), ("MULTILINESTRING", 2), ("POINT", 1), ("LINESTRING", 1), ("LINESTRING", 1), ("MULTILINESTRING", 2),
        ("POINT", 1), ("GEOMETRYCOLLECTION", None), ("GEOMETRYCOLLECTION", 1), ("POINT", 1), ("POINT", 1), ("GEOMETRYCOLLECTION", None),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_areas_of_random_overlaps(spark, seed):
    """Stars across a comb with a hole have the area that clipping by half-planes gives, in valid rings."""
    r = random.Random(seed)
    teeth = [p for i in range(5) for p in ((i * 2, 5), (i * 2 + 1, 5), (i * 2 + 1, 2), (i * 2 + 2, 2))]
    comb = Area([(10, 0), *[(x, y) for x, y in reversed(teeth)], (0, 0)], [[(1, 0.5), (1, 1.5), (8, 1.5), (8, 0.5)]])
    shapes = []
    for _ in range(60):
        x, y, n = r.uniform(0, 10), r.uniform(0, 5), r.choice([3, 5, 8, 20])
        pts = [(x + d * math.cos(a), y + d * math.sin(a)) for a, d in ((2 * math.pi * k / n, r.uniform(0.3, 4)) for k in range(n))]
        if r.random() < 0.3:  # on whole numbers, so that edges fall together
            x, y, w, h = round(x), round(y), r.randint(1, 5), r.randint(1, 4)
            pts = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        shapes.append("POLYGON((" + ",".join(f"{a!r} {b!r}" for a, b in [*pts, pts[0]]) + "))")
    rows = overlaps(spark, comb, *shapes)
    assert [r.own or 0 for r in rows] == pytest.approx([r.area for r in rows], abs=1e-9)
    assert all(r.valid for r in rows if r.o.geometry is not None and r.o.geometry.gtype in geometry.POLYGONAL)
    assert {"POLYGON", "MULTIPOLYGON"} <= {r.o.kind for r in rows}
