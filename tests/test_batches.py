"""Kernels that look at all geometries of a batch together, against the same work done one by one."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeforge.functions import geometry
from placeforge.functions.formats import from_ewkt
from placeforge.functions.geometry import Area
from placeforge.operators import kernels, leaves, lines, overlay


def _rings(seed: int, count: int, most: int, grid: int) -> list[np.ndarray]:
    r = np.random.default_rng(seed)
    return [r.integers(0, grid, (int(r.integers(1, most)), 2)).astype(float) for _ in range(count)]


def _shapes(rings: list[np.ndarray]) -> kernels._Shapes:
    return kernels._Shapes(kernels.encode_geometries([None if n % 9 == 4 else ("LINESTRING", [[r]]) for n, r in enumerate(rings)]))


@pytest.mark.parametrize("grid", [4, 1000])
def test_rings_are_weighed_together(grid):
    rings = _rings(grid, 400, 30, grid)
    size = np.array([len(r) for r in rings])
    found = kernels._weigh_rings(np.concatenate(rings), np.cumsum(size) - size, size)
    assert found.tolist() == np.concatenate([kernels._weights(r) for r in rings]).tolist()


def test_thinning_together():
    rings = _rings(7, 300, 30, 12)
    thin = _shapes(rings).thinned(np.full(len(rings), 2.0), True).to_pylist()
    for n, (ring, row) in enumerate(zip(rings, thin)):
        if n % 9 == 4:
            assert row is None
            continue
        weights = kernels._weights(ring)
        assert [(p["x"], p["y"]) for p in row["parts"][0][0]] == [tuple(p) for p in ring[weights > 2.0].tolist()]


def test_least_tolerances_together():
    rings = _rings(8, 300, 30, 12)
    found = kernels._least_tolerances(_shapes(rings), 6)
    for n, (ring, tolerance) in enumerate(zip(rings, found.tolist())):
        if n % 9 != 4:
            weights = kernels._weights(ring)
            steps = [0.0, *sorted(w for w in weights.tolist() if np.isfinite(w))]
            assert tolerance == next((t for t in steps if (weights > t).sum() <= 6), steps[-1])


def test_polygons_of_several_rings_are_tested_together():
    r = np.random.default_rng(9)

    def box(x, y, w, h):
        return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)], float)

    parts = []
    for _ in range(600):
        holes = [box(*r.integers(0, 8, 2), *r.integers(1, 4, 2)) for _ in range(r.integers(0, 5))]
        parts.append([box(0, 0, 9, 9), *holes])
    # holes that touch in a ring part the inside; a spike and a repeated point
    parts.append([box(0, 0, 9, 9), box(1, 1, 2, 2), box(3, 3, 2, 2), box(5, 1, 2, 2), np.array([(3, 1), (4, 0.5), (5, 1), (4, 1), (3, 1)], float)])
    parts.append([box(0, 0, 9, 9), np.array([(1, 1), (3, 1), (2, 1), (2, 2), (1, 1)], float)])
    parts.append([np.array([(0, 0), (0, 0), (4, 0), (4, 4), (0, 0)], float)])
    at = [(r, p) for p, part in enumerate(parts) for r in part]
    size = np.array([len(ring) for ring, _ in at])
    owner = np.array([p for _, p in at])
    found = kernels._valid_small_polygons(np.concatenate([ring for ring, _ in at]), np.cumsum(size) - size, size, owner, len(parts))
    assert found.tolist() == [kernels._valid_polygon(p) for p in parts]
    assert 0 < found.sum() < len(found)


def test_crowded_cells_are_compared_in_small_blocks(monkeypatch):
    """A thousand points of a cell against a thousand of another whose boxes leave it open, and many such pairs."""
    seen, distances = [], leaves.segment_distances

    def counted(a, b):
        seen.append(len(a))
        return distances(a, b)

    monkeypatch.setattr(leaves, "segment_distances", counted)
    left = np.repeat([(0.0, 0.0), (60.0, 69.0)], 500, axis=0)
    right = np.repeat([(158.0, 0.0)], 1000, axis=0)
    few = np.array([(0.0, 0.0), (60.0, 69.0), (158.0, 0.0)] * 20)
    points = np.concatenate([left, right, *[few + (1000.0 * k, 0.0) for k in range(1, 400)]])
    place = np.repeat(np.arange(400), [2000, *[60] * 399])
    n = np.arange(len(points))
    label = leaves.solve(np.zeros(len(n), np.int64), n, np.zeros(len(n), np.int64), np.hstack([points, points]), np.zeros(len(n), bool), 100.0)
    side = points[:, 0] - 1000.0 * place > 100
    _, first = np.unique(place * 2 + side, return_index=True)
    assert label.tolist() == first[place * 2 + side].tolist()
    assert sum(seen) >= 1_000_000 and max(seen) <= 1 << 17


def test_overlaps_together():
    """Stars, boxes with holes, lines and points on whole numbers and off them, at once and one at a time."""
    r = np.random.default_rng(10)
    area = [[(0.0, 0.0), (9.0, 0.0), (9.0, 6.0), (6.0, 6.0), (6.0, 2.0), (3.0, 2.0), (3.0, 6.0), (0.0, 6.0), (0.0, 0.0)]]
    shapes = []
    for n in range(300):
        x, y, w, h = (float(v) for v in (*r.integers(-2, 9, 2), *r.integers(2, 10, 2)))
        x += float(r.uniform(-0.5, 0.5)) if n % 3 else 0.0
        box = np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)])
        hole = np.array([(x + 0.5, y + 0.5), (x + 0.5, y + 1), (x + 1, y + 1), (x + 1, y + 0.5), (x + 0.5, y + 0.5)])
        shapes.append([None, ("POLYGON", [[box, hole]]), ("MULTILINESTRING", [[box[:3]], [box[2:]]]), ("MULTIPOINT", [[[p]] for p in box])][n % 4])

    def plain(found):
        return found and (found[0], found[1] and (found[1][0], [[np.asarray(ring).tolist() for ring in part] for part in found[1][1]]))

    together = [plain(f) for f in overlay._overlaps(shapes, area)]
    assert together == [plain(overlay._overlaps([s], area)[0]) for s in shapes]
    assert {"POLYGON", "MULTIPOLYGON", "MULTILINESTRING", "POINT", overlay.NOTHING} <= {f[0] for f in together if f}


def test_plain_rings_are_followed_together(monkeypatch):
    """Only an overlap that meets itself in a point is followed edge by edge; shells and holes as when all are."""
    area = [[(0.0, 0.0), (9.0, 0.0), (9.0, 6.0), (6.0, 6.0), (6.0, 2.0), (3.0, 2.0), (3.0, 6.0), (0.0, 6.0), (0.0, 0.0)]]
    box = lambda x, y, w, h: np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)])
    shapes = [("POLYGON", [[box(x, 2.5, 8.0, 2.5), box(x + 0.5, 3.0, 1.0, 1.0)]]) for x in np.arange(-6.03, 8.0, 0.25)]
    pinched = ("POLYGON", [[np.array([(1.0, 1.0), (2.0, 1.0), (3.0, 3.0), (2.0, 5.0), (1.0, 5.0), (1.0, 1.0)]), box(2.0, 2.5, 1.0, 1.0)]])
    bow = ("POLYGON", [[np.array([(0.5, 0.5), (1.0, 1.0), (1.5, 0.5), (1.5, 1.5), (1.0, 1.0), (0.5, 1.5), (0.5, 0.5)])]])
    calls = []
    follow = overlay._rings
    monkeypatch.setattr(overlay, "_rings", lambda edges: calls.append(len(edges)) or follow(edges))
    found = overlay._overlaps(shapes, area)
    assert not calls
    assert {f[0] for f in found} == {"POLYGON", "MULTIPOLYGON"} and {len(part) for f in found for part in f[1][1]} == {1, 2}
    odd = overlay._overlaps([*shapes[:3], bow, pinched], area)
    assert calls and odd[3][0] == "MULTIPOLYGON" and len(odd[3][1][1]) == 2

    one_by_one = []

    def all_odd(unit, a, b, xy):
        for u in sorted(set(unit.tolist())):
            some = unit == u
            rings = follow(list(zip(map(tuple, xy[a[some]].tolist()), map(tuple, xy[b[some]].tolist()))))
            one_by_one.extend((u, np.array(r)) for r in rings)
        return [r for _, r in one_by_one], np.array([u for u, _ in one_by_one], int)

    monkeypatch.setattr(overlay, "_shared_rings", all_odd)
    again = overlay._overlaps(shapes, area)
    plain = lambda found: [(kind, [[ring.tolist() for ring in part] for part in shape[1]]) for kind, shape in found]
    assert plain(found) == plain(again)


def test_far_pieces_are_not_cut(spark):
    """A box that only two teeth of a comb reach, by hand; and the plan tests pieces before it cuts them."""
    teeth = [p for i in range(20) for p in ((i * 2.0, 5.0), (i * 2 + 1.0, 5.0), (i * 2 + 1.0, 2.0), (i * 2 + 2.0, 2.0))]
    comb = Area([(40.0, 0.0), *reversed(teeth), (0.0, 0.0)])
    box = geometry.make_box(*map(F.lit, (4.5, 3.0, 6.5, 4.0)))
    found = spark.range(1).select(box.alias("g")).select(geometry.intersection_area(F.col("g"), comb).alias("a"))
    assert found.first()["a"] == pytest.approx(1.0)
    assert "filter(" in found._jdf.queryExecution().analyzed().toString()


def test_two_point_ways_are_read_off_rows(spark, monkeypatch):
    """Ways of two points, of three, and of points that became one, as when all of them are collected."""
    points = [(0, 1), (1, 1), (2, 0), (3, 1), (3, 1), (4, 0), (5, 0), (6, 1)]
    rows = [(1, line, n, 0.0, float(x + line), 0.0, bool(node)) for line in (1, 2) for n, (x, node) in enumerate(points)]
    marked = spark.createDataFrame(rows, "grp long, line long, n int, t double, x double, y double, node boolean")
    found = sorted(tuple(p.x for p in r.pts) for r in lines._ways(marked).collect())
    assert found == [(1, 2), (2, 3), (2, 3, 4), (3, 4, 5), (4, 5, 6, 7), (5, 6, 7, 8)]
    monkeypatch.setattr(lines, "_LONG_LINE", 1)
    assert found == sorted(tuple(p.x for p in r.pts) for r in lines._ways(marked).collect())


def test_tables_of_a_union_go_once_read(spark, monkeypatch):
    """A union gives back the disk of its steps; only what its result is read from stays."""
    written = []
    durable = lines.durable
    monkeypatch.setattr(lines, "durable", lambda df, name: written.append(table := durable(df, name)) or table)
    shapes = [(1, n, f"LINESTRING({n} 0,{n + 2} 2)") for n in range(4)] + [(1, 9, "LINESTRING(0 1,9 1)"), (2, 1, "LINESTRING(0 0,1 1)")]
    rows = spark.createDataFrame(shapes, "grp long, line long, t string").select("grp", "line", from_ewkt(F.col("t")).alias("geometry"))
    found = {r.grp: len(r.geometry.parts) for r in lines.union_lines(rows).collect()}
    assert found == {1: 13, 2: 1}
    left = {Path(t._work_path).name.split("-")[0] for t in written if Path(t._work_path).exists()}
    assert len(written) > 6 and left <= {"moves"}
