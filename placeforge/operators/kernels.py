"""Arrow batch kernels for the geometry steps that column expressions cannot do well.

Each works on the geometries of a batch inside Spark's tasks; points and lines reach them as nulls only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeforge.functions.geometry import LINEAR, POINTS, POLYGONAL, num_points
from placeforge.schema import GEOMETRY

Ring = np.ndarray  # n x 2


def _flat(batch: pa.StructArray):
    """All coordinates of an Arrow geometry column, and where each geometry, part and ring starts."""
    parts = batch.field("parts")
    rings = parts.values
    lines = rings.values
    pts = lines.values
    xy = np.column_stack([np.asarray(pts.field("x"), float), np.asarray(pts.field("y"), float)])
    return xy, *(np.asarray(a.offsets) for a in (parts, rings, lines))


def decode_geometries(batch: pa.StructArray):
    """Yields (gtype, parts as lists of n x 2 arrays) or None per row of an Arrow geometry column."""
    types = batch.field("gtype").to_pylist()
    xy, part_at, ring_at, point_at = _flat(batch)
    for i, present in enumerate(batch.is_valid().to_pylist()):
        if not present or types[i] is None:
            yield None
            continue
        yield types[i], [
            [xy[point_at[r] : point_at[r + 1]] for r in range(ring_at[p], ring_at[p + 1])]
            for p in range(part_at[i], part_at[i + 1])
        ]


def encode_geometries(rows: list) -> pa.Array:
    """Arrow geometry column of (gtype, parts) or None per row."""
    present = [r for r in rows if r is not None]
    parts = [p for _, ps in present for p in ps]
    rings = [r for p in parts for r in p]
    xy = np.concatenate([np.empty((0, 2)), *rings])

    def offsets(sizes: list[int]) -> np.ndarray:
        return np.r_[0, np.cumsum(sizes, dtype=np.int64)].astype(np.int32)

    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    lines = pa.ListArray.from_arrays(offsets([len(r) for r in rings]), points)
    nested = pa.ListArray.from_arrays(offsets([len(p) for p in parts]), lines)
    shapes = pa.ListArray.from_arrays(offsets([0 if r is None else len(r[1]) for r in rows]), nested)
    types = pa.array([None if r is None else r[0] for r in rows], pa.string())
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.StructArray.from_arrays([types, shapes], ["gtype", "parts"], mask=missing)


# ---- validity ----

_PAIRS_AT_ONCE = 1 << 17


def _cross(o, a, b):
    return (a[..., 0] - o[..., 0]) * (b[..., 1] - o[..., 1]) - (a[..., 1] - o[..., 1]) * (b[..., 0] - o[..., 0])


def _near_pairs(p0, p1, q0, q1):
    """Blocks of index pairs of segments whose x and y ranges meet, found along sorted x."""
    lo, hi = np.minimum(q0, q1), np.maximum(q0, q1)
    order = np.argsort(lo[:, 0], kind="stable")
    starts = lo[order, 0]
    widest = float((hi[:, 0] - lo[:, 0]).max())
    plo, phi = np.minimum(p0, p1), np.maximum(p0, p1)
    first = np.searchsorted(starts, plo[:, 0] - widest, "left")
    last = np.searchsorted(starts, phi[:, 0], "right")
    counts = last - first
    ends = np.cumsum(counts)
    done = 0
    while done < len(p0):
        upto = max(done + 1, int(np.searchsorted(ends, ends[done] - counts[done] + _PAIRS_AT_ONCE, "right")))
        n = counts[done:upto]
        i = np.repeat(np.arange(done, min(upto, len(p0))), n)
        within = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        j = order[first[i] + within]
        meet = (lo[j] <= phi[i]).all(axis=1) & (hi[j] >= plo[i]).all(axis=1)
        yield i[meet], j[meet]
        done = upto


def _sides(a0, a1, b0, b1):
    return (
        np.sign(_cross(a0, a1, b0)), np.sign(_cross(a0, a1, b1)),
        np.sign(_cross(b0, b1, a0)), np.sign(_cross(b0, b1, a1)),
    )


def _steps(ring: Ring):
    return ring[:-1], ring[1:]


def _simple_ring(ring: Ring) -> bool:
    """Closed, with area, and touching itself nowhere but at neighbouring corners."""
    if len(ring) < 4 or not np.isfinite(ring).all() or (ring[0] != ring[-1]).any():
        return False
    ring = ring[np.r_[True, (np.diff(ring, axis=0) != 0).any(axis=1)]]
    if len(ring) < 4:
        return False
    a, b = _steps(ring)
    n = len(a)
    turn = _cross(a, b, np.roll(b, -1, axis=0))
    back = ((b - a) * (np.roll(b, -1, axis=0) - b)).sum(axis=1) < 0
    if ((turn == 0) & back).any():  # a spike
        return False
    for i, j in _near_pairs(a, b, a, b):
        apart = (i < j) & (j - i > 1) & ~((i == 0) & (j == n - 1))
        i, j = i[apart], j[apart]
        d1, d2, d3, d4 = _sides(a[i], b[i], a[j], b[j])
        if ((d1 * d2 <= 0) & (d3 * d4 <= 0)).any():
            return False
    return True


def _crossing_or_along(a0, a1, b0, b1) -> np.ndarray:
    d1, d2, d3, d4 = _sides(a0, a1, b0, b1)
    flat = (d1 == 0) & (d2 == 0)
    along = a1 - a0
    own = (along * along).sum(axis=1)
    t0 = ((b0 - a0) * along).sum(axis=1)
    t1 = ((b1 - a0) * along).sum(axis=1)
    shared = np.minimum(np.maximum(t0, t1), own) - np.maximum(np.minimum(t0, t1), 0)
    return ((d1 * d2 < 0) & (d3 * d4 < 0)) | (flat & (own > 0) & (shared > 0))


def _cross_or_overlap(r: Ring, s: Ring) -> bool:
    """Do two rings cross, or run along each other, rather than only touch at points?"""
    (a0, a1), (b0, b1) = _steps(r), _steps(s)
    for i, j in _near_pairs(a0, a1, b0, b1):
        if _crossing_or_along(a0[i], a1[i], b0[j], b1[j]).any():
            return True
    return False


def _locate(ring: Ring, pts: np.ndarray) -> np.ndarray:
    """1 inside, 0 on the ring, -1 outside."""
    a, b = _steps(ring)
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    found = np.empty(len(pts), int)
    step = max(1, _PAIRS_AT_ONCE // max(1, len(a)))
    for at in range(0, len(pts), step):
        p = pts[at : at + step, None]
        side = _cross(a, b, p)
        on = (side == 0) & (lo <= p).all(axis=2) & (p <= hi).all(axis=2)
        straddles = (a[:, 1] > p[..., 1]) != (b[:, 1] > p[..., 1])
        right = np.where(b[:, 1] > a[:, 1], side > 0, side < 0)
        inside = (straddles & right).sum(axis=1) % 2 == 1
        found[at : at + step] = np.where(on.any(axis=1), 0, np.where(inside, 1, -1))
    return found


def _probes(ring: Ring) -> np.ndarray:
    a, b = _steps(ring)
    return np.concatenate([a, (a + b) / 2])


def _in_one_piece(rings: list[Ring]) -> bool:
    """Is the inside of nested rings that only touch connected?

    Rings and the points where they touch are the nodes of a graph, with an edge where a ring goes through a point: a
    cycle of it goes around a part of the inside.
    """
    touching: dict[tuple, set[int]] = {}
    boxes = [(r.min(axis=0), r.max(axis=0)) for r in rings]
    for i, ring in enumerate(rings):
        for j, other in enumerate(rings):
            if i != j and (boxes[i][0] <= boxes[j][1]).all() and (boxes[j][0] <= boxes[i][1]).all():
                corners = ring[:-1]
                for p in corners[_locate(other, corners) == 0].tolist():
                    touching.setdefault(tuple(p), set()).update((i, j))
    return not _goes_around(touching)


def _goes_around(touching: dict[tuple, set[int]]) -> bool:
    """Has the graph of points, and of the rings that go through each, a cycle?"""
    root: dict = {}

    def find(n):
        while root.setdefault(n, n) != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for point, through in touching.items():
        for ring_no in through:
            a, b = find(ring_no), find(point)
            if a == b:
                return True
            root[a] = b
    return False


def _valid_polygon(part: list[Ring]) -> bool:
    if not part or not all(_simple_ring(r) for r in part):
        return False
    shell, holes = part[0], part[1:]
    for n, hole in enumerate(holes):
        if _cross_or_overlap(shell, hole) or (_locate(shell, _probes(hole)) < 0).any():
            return False
        for other in holes[:n]:
            if (
                _cross_or_overlap(other, hole)
                or (_locate(other, _probes(hole)) > 0).any()
                or (_locate(hole, _probes(other)) > 0).any()
            ):
                return False
    return not holes or _in_one_piece(part)


def _inside_part(part: list[Ring], ring: Ring) -> bool:
    """Does any of the ring lie in the interior of the polygon?"""
    probes = _probes(ring)
    inside = _locate(part[0], probes) > 0
    for hole in part[1:]:
        inside &= _locate(hole, probes) < 0
    return bool(inside.any())


def _valid_parts(parts: list[list[Ring]]) -> bool:
    if not all(_valid_polygon(p) for p in parts):
        return False
    for n, part in enumerate(parts):
        for other in parts[:n]:
            if any(_cross_or_overlap(r, s) for r in part for s in other):
                return False
            if _inside_part(other, part[0]) or _inside_part(part, other[0]):
                return False
    return True


_SMALL_RING = 64  # rings up to this size are tested many at a time, all pairs of their segments


def _simple_small_rings(stack: np.ndarray) -> np.ndarray:
    """``_simple_ring`` for many rings of one size without repeated points: rings x points x 2."""
    count, size, _ = stack.shape
    if size < 4:
        return np.zeros(count, bool)
    good = np.isfinite(stack).all(axis=(1, 2)) & (stack[:, 0] == stack[:, -1]).all(axis=1)
    a, b = stack[:, :-1], stack[:, 1:]
    following = np.roll(b, -1, axis=1)
    back = ((b - a) * (following - b)).sum(axis=2) < 0
    good &= ~((_cross(a, b, following) == 0) & back).any(axis=1)
    i, j = np.triu_indices(size - 1, 2)
    apart = ~((i == 0) & (j == size - 2))
    i, j = i[apart], j[apart]
    step = max(1, _PAIRS_AT_ONCE // max(1, len(i)))
    for at in range(0, count, step):
        p, q = a[at : at + step], b[at : at + step]
        lo, hi = np.minimum(p, q), np.maximum(p, q)
        meet = (lo[:, i] <= hi[:, j]).all(axis=2) & (lo[:, j] <= hi[:, i]).all(axis=2)
        d1, d2, d3, d4 = _sides(p[:, i], q[:, i], p[:, j], q[:, j])
        good[at : at + step] &= ~(meet & (d1 * d2 <= 0) & (d3 * d4 <= 0)).any(axis=1)
    return good


_MOST_RINGS = 64  # of a polygon whose rings are tested in pairs together with those of others


def _blocks(size: np.ndarray) -> list[np.ndarray]:
    """Numbers of consecutive items with about ``_PAIRS_AT_ONCE`` in all, or one."""
    return np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // _PAIRS_AT_ONCE)) + 1)


class _SmallRings:
    """Rings by flat arrays; questions about many pairs (r, s) of them, all segments of r against all points of s."""

    def __init__(self, xy: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.xy, self.first, self.steps = xy, first, size - 1

    def _paired(self, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, number below n, number below m) for all of each pair, the last running fastest."""
        pair = np.repeat(np.arange(len(n)), n * m)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        return pair, within // m[pair], within % m[pair]

    def cross_or_overlap(self, r: np.ndarray, s: np.ndarray) -> np.ndarray:
        found = np.zeros(len(r), bool)
        for some in _blocks(self.steps[r] * self.steps[s]):
            pair, i, j = self._paired(self.steps[r[some]], self.steps[s[some]])
            i, j = self.first[r[some]][pair] + i, self.first[s[some]][pair] + j
            a0, a1, b0, b1 = self.xy[i], self.xy[i + 1], self.xy[j], self.xy[j + 1]
            meet = (np.minimum(b0, b1) <= np.maximum(a0, a1)).all(axis=1) & (np.maximum(b0, b1) >= np.minimum(a0, a1)).all(axis=1)
            pair, a0, a1, b0, b1 = pair[meet], a0[meet], a1[meet], b0[meet], b1[meet]
            found[some[pair[_crossing_or_along(a0, a1, b0, b1)]]] = True
        return found

    def locate(self, r: np.ndarray, s: np.ndarray, middles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, point, 1 inside r, 0 on it, -1 outside) of the corners of s, and the middles of its segments."""
        pairs, points, places = [np.zeros(0, np.int64)], [np.zeros((0, 2))], [np.zeros(0, np.int64)]
        probes = self.steps[s] * (2 if middles else 1)
        for some in _blocks(probes * self.steps[r]):
            n, m = probes[some], self.steps[r[some]]
            pair, k, edge = self._paired(n, m)
            own = self.steps[s[some]][pair]
            corner = self.first[s[some]][pair] + k % own
            p = np.where((k < own)[:, None], self.xy[corner], (self.xy[corner] + self.xy[corner + 1]) / 2)
            edge += self.first[r[some]][pair]
            a, b = self.xy[edge], self.xy[edge + 1]
            side = _cross(a, b, p)
            on = (side == 0) & (np.minimum(a, b) <= p).all(axis=1) & (p <= np.maximum(a, b)).all(axis=1)
            straddles = (a[:, 1] > p[:, 1]) != (b[:, 1] > p[:, 1])
            right = np.where(b[:, 1] > a[:, 1], side > 0, side < 0)
            start = np.flatnonzero(edge == self.first[r[some]][pair])  # a probe's first segment
            probe = np.repeat(np.arange(len(start)), m[pair[start]])
            inside = np.bincount(probe[straddles & right], minlength=len(start)) % 2 == 1
            on = np.bincount(probe[on], minlength=len(start)) > 0
            pairs.append(some[pair[start]])
            points.append(p[start])
            places.append(np.where(on, 0, np.where(inside, 1, -1)))
        return np.concatenate(pairs), np.concatenate(points), np.concatenate(places)

    def any_located(self, r: np.ndarray, s: np.ndarray, place: int) -> np.ndarray:
        """Is a corner or middle of s inside r (1), or outside (-1)?"""
        pair, _, found = self.locate(r, s, True)
        return np.bincount(pair[found == place], minlength=len(r)) > 0


def _valid_small_polygons(xy: np.ndarray, first: np.ndarray, size: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """``_valid_polygon`` for many polygons of small rings; ``owner`` numbers the polygon of each ring, ascending."""
    simple = np.zeros(len(first), bool)
    for n in np.unique(size):
        of_size = np.flatnonzero(size == n)
        stack = xy[first[of_size][:, None] + np.arange(n)]
        clean = (np.diff(stack, axis=1) != 0).any(axis=2).all(axis=1)
        simple[of_size[clean]] = _simple_small_rings(stack[clean])
        simple[of_size[~clean]] = [_simple_ring(r) for r in stack[~clean]]
    good = np.ones(count, bool)
    good[owner[~simple]] = False
    rings = _SmallRings(xy, first, size)
    # pairs (earlier, later) of the rings of a polygon
    total = np.bincount(owner, minlength=count)
    place = np.arange(len(owner)) - (np.cumsum(total) - total)[owner]
    held = np.flatnonzero(good[owner])
    later = np.repeat(held, place[held])
    earlier = later - place[later] + np.arange(len(later)) - np.repeat(np.cumsum(place[held]) - place[held], place[held])
    bad = rings.cross_or_overlap(earlier, later)
    shell = place[earlier] == 0
    bad[shell] |= rings.any_located(earlier[shell], later[shell], -1)
    holes = ~shell
    bad[holes] |= rings.any_located(earlier[holes], later[holes], 1) | rings.any_located(later[holes], earlier[holes], 1)
    good[owner[later[bad]]] = False
    # where rings touch, the inside may be parted
    left = good[owner[later]]
    some, others = np.concatenate([earlier[left], later[left]]), np.concatenate([later[left], earlier[left]])
    pair, points, found = rings.locate(others, some, False)
    touching: dict[int, dict[tuple, set[int]]] = {}
    on = found == 0
    for k, p in zip(pair[on].tolist(), points[on].tolist()):
        touching.setdefault(int(owner[some[k]]), {}).setdefault(tuple(p), set()).update((int(some[k]), int(others[k])))
    for polygon, places in touching.items():
        good[polygon] = not _goes_around(places)
    return good


@F.arrow_udf(T.BooleanType())
def _valid_polygons(geoms: pa.Array) -> pa.Array:
    xy, part_at, ring_at, point_at = _flat(geoms)
    present = np.asarray(geoms.is_valid())
    answers = np.zeros(len(geoms), bool)
    sizes = np.diff(point_at)
    # polygons of one part of small rings together
    one_part = np.flatnonzero(present & (np.diff(part_at) == 1))
    part = part_at[one_part]
    total = (ring_at[part + 1] - ring_at[part]).astype(np.int64)
    ring = np.repeat(ring_at[part] - (np.cumsum(total) - total), total) + np.arange(total.sum())
    owner = np.repeat(np.arange(len(part)), total)
    small = (total > 0) & (total <= _MOST_RINGS)
    small[owner[(sizes[ring] > _SMALL_RING) | (sizes[ring] == 0)]] = False
    ring, owner = ring[small[owner]], owner[small[owner]]
    rows = one_part[small]
    owner = (np.cumsum(small) - 1)[owner]
    answers[rows] = _valid_small_polygons(xy, point_at[ring].astype(np.int64), sizes[ring].astype(np.int64), owner, len(rows))
    done = np.zeros(len(geoms), bool)
    done[rows] = True
    left = np.flatnonzero(present & ~done)
    if len(left):
        answers[left] = [_valid_parts(g[1]) for g in decode_geometries(geoms.take(pa.array(left)))]
    return pa.array(answers, mask=~present)


def is_valid(geom: Column) -> Column:
    """Points always; lines with two distinct points; polygons with simple rings, properly nested, around one connected inside."""
    lines = F.forall(geom["parts"], lambda part: F.exists(part[0], lambda p: p != part[0][0]))
    polygons = _valid_polygons(F.when(geom["gtype"].isin(*POLYGONAL), geom))
    return (
        F.when(geom["gtype"].isin(*POINTS), True)
        .when(geom["gtype"].isin(*LINEAR), lines)
        .otherwise(F.coalesce(polygons, F.lit(False)))
    )


# ---- simplification ----

def _weights(line: Ring) -> np.ndarray:
    """How far a tolerance can go before each point drops out of a Douglas-Peucker line; ends never do."""
    weights = np.zeros(len(line))
    weights[[0, -1]] = np.inf
    spans = [(0, len(line) - 1, np.inf)]
    while spans:
        i, j, above = spans.pop()
        if j - i < 2:
            continue
        (ax, ay), (bx, by) = line[i], line[j]
        dx, dy = bx - ax, by - ay
        px, py = line[i + 1 : j, 0] - ax, line[i + 1 : j, 1] - ay
        norm = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / norm, 0, 1) if norm > 0 else 0.0
        off = (px - t * dx) ** 2 + (py - t * dy) ** 2
        k = int(off.argmax())
        weight = min(float(off[k]) ** 0.5, above)
        far = i + 1 + k
        weights[far] = weight
        spans += [(far, j, weight), (i, far, weight)]
    return weights


_POINTS_AT_ONCE = 1 << 18  # points of rings that are weighed together
_LARGE = 1e150  # beyond it squares overflow; such rings are weighed alone


def _weigh_rings(xy: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``_weights`` of many rings, one after the other in ``xy``: all open spans of a depth are looked at together."""
    weights = np.zeros(len(xy))
    some = size > 0
    weights[start[some]] = weights[start[some] + size[some] - 1] = np.inf
    first, last, above = start[size > 2], (start + size)[size > 2] - 1, np.full(int((size > 2).sum()), np.inf)
    while len(first):
        n = last - first - 1
        at = np.cumsum(n) - n
        own = np.repeat(np.arange(len(n)), n)
        here = np.arange(len(own)) - at[own] + first[own] + 1
        base, d = xy[first], xy[last] - xy[first]
        norm = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1]
        px, py, dx, dy = xy[here, 0] - base[own, 0], xy[here, 1] - base[own, 1], d[own, 0], d[own, 1]
        t = np.clip((px * dx + py * dy) / np.where(norm > 0, norm, 1.0)[own], 0, 1)
        t[(norm <= 0)[own]] = 0.0
        off = (px - t * dx) ** 2 + (py - t * dy) ** 2
        most = np.maximum.reduceat(off, at)
        hits = np.flatnonzero(off == most[own])
        far = here[hits[np.searchsorted(hits, at)]]  # the first of a span that is as far off as that
        weight = np.minimum([v**0.5 for v in most.tolist()], above)
        weights[far] = weight
        left, right = far - first > 1, last - far > 1
        first, last = np.concatenate([first[left], far[right]]), np.concatenate([far[left], last[right]])
        above = np.concatenate([weight[left], weight[right]])
    return weights


class _Shapes:
    """The geometries of a batch by flat arrays: rings of parts of rows, with the weight of each point."""

    def __init__(self, geoms: pa.StructArray):
        self.types = geoms.field("gtype")
        xy, part_at, ring_at, point_at = _flat(geoms)
        self.rows = len(geoms)
        present = np.asarray(geoms.is_valid()) & np.asarray(self.types.is_valid())

        def inner(at: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(places, their owners) of what lies in the ranges that start at the places held."""
            n = at[held + 1].astype(np.int64) - at[held]
            owner = np.repeat(np.arange(len(held)), n)
            return at[held].astype(np.int64)[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner], owner

        rows = np.flatnonzero(present)
        parts, part_row = inner(part_at, rows)
        rings, self.ring_part = inner(ring_at, parts)
        points, self.point_ring = inner(point_at, rings)
        self.part_row = rows[part_row]
        self.ring_row = self.part_row[self.ring_part]
        self.xy = xy[points]
        self.size = np.bincount(self.point_ring, minlength=len(rings))
        self.start = np.cumsum(self.size) - self.size
        self.shell = np.ones(len(rings), bool)  # the first ring of its part
        self.shell[1:] = self.ring_part[1:] != self.ring_part[:-1]
        linear = np.zeros(self.rows, bool)
        linear[rows] = np.isin(np.asarray(self.types.take(pa.array(rows)).to_numpy(zero_copy_only=False), object).astype(str), LINEAR)
        self.linear = linear[self.ring_row]
        self.weights = self._weigh()

    def _weigh(self) -> np.ndarray:
        found = np.zeros(len(self.xy))
        odd = np.zeros(len(self.size), bool)
        odd[self.point_ring[~(np.abs(self.xy) < _LARGE).all(axis=1)]] = True
        for ring in np.flatnonzero(odd):
            held = slice(self.start[ring], self.start[ring] + self.size[ring])
            found[held] = _weights(self.xy[held])
        plain = np.flatnonzero(~odd)
        block = np.cumsum(self.size[plain]) // _POINTS_AT_ONCE
        for rings in np.split(plain, np.flatnonzero(np.diff(block)) + 1):
            n = self.size[rings]
            at = np.repeat(self.start[rings] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found[at] = _weigh_rings(self.xy[at], np.cumsum(n) - n, n)
        return found

    def least(self, keep_collapsed: bool) -> np.ndarray:
        """Points that are left of each ring at any rate: two of a line, four of a shell."""
        return np.where(self.linear, 2, np.where(self.shell & keep_collapsed, 4, 0))

    def counts(self, tolerance: np.ndarray, keep_collapsed: bool) -> np.ndarray:
        """Points that are left of each ring at a tolerance for each row."""
        kept = self.weights > tolerance[self.ring_row][self.point_ring]
        n = np.bincount(self.point_ring[kept], minlength=len(self.size))
        least = self.least(keep_collapsed)
        return np.where((n < least) & (least <= self.size), least, n)

    def kept_rings(self, n: np.ndarray) -> np.ndarray:
        """Is a ring left, with its part, if ``n`` points of it are? Lines are."""
        whole = np.zeros(len(self.part_row), bool)
        whole[self.ring_part[self.shell]] = (self.linear | (n >= 4))[self.shell]
        return np.where(self.linear, self.shell, whole[self.ring_part] & (n >= 4))

    def thinned(self, tolerance: np.ndarray, keep_collapsed: bool) -> pa.Array:
        keep = self.weights > tolerance[self.ring_row][self.point_ring]
        least = self.least(keep_collapsed)
        short = (np.bincount(self.point_ring[keep], minlength=len(self.size)) < least) & (least <= self.size)
        at = np.flatnonzero(short[self.point_ring])
        if len(at):  # the points that last longest, the first of equal ones
            order = at[np.lexsort((-self.weights[at], self.point_ring[at]))]
            ring = self.point_ring[order]
            new = np.flatnonzero(np.r_[True, ring[1:] != ring[:-1]])
            place = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
            keep[order] = place < least[ring]
        ring_left = self.kept_rings(np.bincount(self.point_ring[keep], minlength=len(self.size)))
        if not keep_collapsed:
            at = np.flatnonzero(keep)
            ring = self.point_ring[at]
            new = np.r_[True, ring[1:] != ring[:-1]][: len(at)]
            lead = at[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(at) else at
            moves = np.zeros(len(self.size), bool)
            moves[ring[(self.xy[at] != self.xy[lead]).any(axis=1)]] = True
            ring_left &= ~self.linear | moves
        keep &= ring_left[self.point_ring]
        part_left = np.zeros(len(self.part_row), bool)
        part_left[self.ring_part[ring_left]] = True
        missing = np.ones(self.rows, bool)
        missing[self.part_row[part_left]] = False

        def offsets(owner: np.ndarray, left: np.ndarray) -> np.ndarray:
            return np.r_[0, np.cumsum(np.bincount(owner, minlength=len(left))[left])].astype(np.int32)

        xy = self.xy[keep]
        points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
        lines = pa.ListArray.from_arrays(offsets(self.point_ring[keep], ring_left), points)
        nested = pa.ListArray.from_arrays(offsets(self.ring_part[ring_left], part_left), lines)
        shapes = pa.ListArray.from_arrays(offsets(self.part_row[part_left], np.ones(self.rows, bool)), nested)
        return pa.StructArray.from_arrays([self.types, shapes], ["gtype", "parts"], mask=pa.array(missing))


def simplify(geom: Column, tolerance: float, keep_collapsed: bool = True) -> Column:
    """Lines and rings thinned so that no dropped point was farther off than the tolerance.

    Rings that collapse are dropped; with ``keep_collapsed`` a shell keeps four points.
    """

    @F.arrow_udf(GEOMETRY)
    def thin(geoms: pa.Array) -> pa.Array:
        return _Shapes(geoms).thinned(np.full(len(geoms), float(tolerance)), keep_collapsed)

    plain = (num_points(geom) < 3) | geom["gtype"].isin(*POINTS)  # nothing to drop
    return F.when(plain, geom).otherwise(thin(F.when(~plain, geom)))


def _least_tolerances(shapes: _Shapes, max_points: int) -> np.ndarray:
    """For each row the smallest tolerance that leaves at most ``max_points``; its largest weight if none does.

    The points left only fall with the tolerance and change at weights alone, so the weights of all rings of a row are searched.
    """
    finite = np.isfinite(shapes.weights)
    row = np.concatenate([np.arange(shapes.rows), shapes.ring_row[shapes.point_ring][finite]])
    weight = np.concatenate([np.zeros(shapes.rows), shapes.weights[finite]])
    order = np.lexsort((weight, row))
    row, weight = row[order], weight[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (weight[1:] != weight[:-1])
    row, steps = row[new], weight[new]
    count = np.bincount(row, minlength=shapes.rows)
    start = np.cumsum(count) - count
    lo, hi = np.zeros(shapes.rows, np.int64), count - 1
    while (lo < hi).any():
        middle = (lo + hi) // 2
        n = shapes.counts(steps[start + middle], True)
        held = shapes.kept_rings(n)
        left = np.bincount(shapes.ring_row[held], n[held], shapes.rows)
        fits, open_ = left <= max_points, lo < hi
        hi = np.where(open_ & fits, middle, hi)
        lo = np.where(open_ & ~fits, middle + 1, lo)
    return steps[start + lo]


def simplify_to(geom: Column, max_points: int) -> Column:
    """Thinned to at most ``max_points``, by the smallest tolerance over all rings that does it.

    Lines keep their ends and shells four points, closed, so that many of them may leave more.
    """

    @F.arrow_udf(GEOMETRY)
    def thin(geoms: pa.Array) -> pa.Array:
        shapes = _Shapes(geoms)
        return shapes.thinned(_least_tolerances(shapes, max_points), True)

    plain = (num_points(geom) <= max_points) | geom["gtype"].isin(*POINTS)
    return F.when(plain, geom).otherwise(thin(F.when(~plain, geom)))


# ---- binary input ----

# Geometry codes and flags of the extended well-known binary form.
WKB_TYPES = {
    1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON",
}
FLAG_SRID, FLAG_Z, FLAG_M = 0x20000000, 0x80000000, 0x40000000


class _Bytes:
    """All values of a batch as one run of bytes, read at many places at once."""

    def __init__(self, values: pa.Array):
        values = values.cast(pa.large_binary())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        self.start, self.end = offsets[:-1], offsets[1:]
        self.data = np.frombuffer(values.buffers()[2] or b"", np.uint8)

    def numbers(self, at: np.ndarray, big: np.ndarray, kind: str) -> np.ndarray:
        """Numbers of 4 or 8 bytes at places of either byte order."""
        size = np.dtype(kind).itemsize
        raw = self.data[at[:, None] + np.arange(size)]
        raw[big] = raw[big, ::-1]
        return raw.copy().view("<" + kind).ravel()


def _headers(values: _Bytes, at: np.ndarray, end: np.ndarray, good: np.ndarray) -> tuple:
    """(type code 1 to 6 or 0, coordinates per point, big-endian, place after the header) of geometries at places."""
    ok = good & (at + 5 <= end)
    order = values.data[np.where(ok, at, 0)] if len(values.data) else np.zeros(len(at), np.uint8)
    ok &= order <= 1
    big = order == 0
    code = np.zeros(len(at), np.int64)
    code[ok] = values.numbers(at[ok] + 1, big[ok], "u4")
    width = 2 + ((code & FLAG_Z) > 0) + ((code & FLAG_M) > 0)
    kind = np.where(ok & np.isin(code & 0x0FFFFFFF & ~np.int64(FLAG_SRID), list(WKB_TYPES)), code & 0xFF, 0)
    return kind, width, big, at + 5 + 4 * ((code & FLAG_SRID) > 0)


def _counts(values: _Bytes, at: np.ndarray, end: np.ndarray, big: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number at each place, is it there)."""
    good = good & (at + 4 <= end)
    n = np.zeros(len(at), np.int64)
    n[good] = values.numbers(at[good], big[good], "u4")
    return n, good


def _read_ewkb(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(geometries, is each value whole) of a column of binary forms; heights and measures are left out.

    All values are walked at once, a step for each level: headers of the values, of the parts of multiple ones, then ring
    after ring. A value that does not end where its content does, or of an unknown type, fails alone and is null.
    """
    values = _Bytes(column)
    rows = len(column)
    good = np.asarray(column.is_valid())
    end = values.end
    top, width, big, at = _headers(values, values.start, end, good)
    good &= top > 0
    # parts: (row, kind, width, big, place), one for a single geometry
    multiple = good & (top >= 4)
    n, there = _counts(values, at, end, big, multiple)
    good &= ~multiple | (there & (n <= end - at))  # no more parts than bytes
    left = np.where(multiple & good, n, 0)
    at = np.where(multiple, at + 4, at)
    single = good & ~multiple
    part_rows, rings = [], []  # per part its row and place in the order of reading; per ring (part, place, points, width, big)
    turn = 0
    while True:
        now = np.flatnonzero(good & (single if turn == 0 else False) | (good & (left > 0)))
        if not len(now):
            break
        inner = multiple[now]
        kind, w, b, place = top[now].copy(), width[now].copy(), big[now].copy(), at[now].copy()
        if inner.any():
            k, kw, kb, kp = _headers(values, at[now][inner], end[now][inner], np.ones(int(inner.sum()), bool))
            kind[inner], w[inner], b[inner], place[inner] = k, kw, kb, kp
            good[now[inner]] &= k == top[now[inner]] - 3
        alive = good[now]
        number = np.arange(len(now)) + sum(map(len, part_rows))
        part_rows.append(now)
        # rings of each part: one for points and lines
        polygon = alive & (kind == 3)
        r, there = _counts(values, place, end[now], b, polygon)
        alive &= ~polygon | (there & (r <= end[now] - place))
        place = np.where(polygon, place + 4, place)
        todo = np.where(polygon, r, 1)
        while True:
            some = np.flatnonzero(alive & (todo > 0))
            if not len(some):
                break
            line = kind[some] != 1
            size, there = _counts(values, place[some], end[now[some]], b[some], line)
            size = np.where(line, size, 1)
            first = place[some] + 4 * line
            last = first + 8 * size * w[some]
            whole = (~line | there) & (last <= end[now[some]]) & (size <= end[now[some]] - place[some])
            alive[some[~whole]] = False
            some, first, size, last = some[whole], first[whole], size[whole], last[whole]
            rings.append(np.column_stack([number[some], first, size, w[some], b[some]]))
            place[some] = last
            todo[some] -= 1
        good[now[~alive]] = False
        at[now] = place
        left[now] -= 1
        single[now] = False
        turn += 1
    good &= at == end  # nothing is left over
    owner = np.concatenate(part_rows or [np.zeros(0, np.int64)])
    ring = np.concatenate(rings or [np.zeros((0, 5), np.int64)])
    # in the order of rows; a row's parts, and a part's rings, were read in their order
    part_order = np.argsort(owner, kind="stable")
    part_order = part_order[good[owner[part_order]]]
    rank = np.full(len(owner), -1, np.int64)
    rank[part_order] = np.arange(len(part_order))
    ring = ring[rank[ring[:, 0]] >= 0]
    ring = ring[np.argsort(rank[ring[:, 0]], kind="stable")]
    _, first, size, w, b = ring.T if len(ring) else np.zeros((5, 0), np.int64)
    before = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(before, size)
    place = np.repeat(first, size) + within * 8 * np.repeat(w, size)
    flip = np.repeat(b, size).astype(bool)
    empty = np.zeros(0)
    xs, ys = (values.numbers(place + 8 * axis, flip, "f8") if len(place) else empty for axis in (0, 1))

    def offsets(counts: np.ndarray) -> pa.Array:
        return pa.array(np.r_[0, np.cumsum(counts)], pa.int32())

    points = pa.StructArray.from_arrays([pa.array(xs), pa.array(ys)], ["x", "y"])
    lines = pa.ListArray.from_arrays(offsets(size), points)
    parts = pa.ListArray.from_arrays(offsets(np.bincount(rank[ring[:, 0]], minlength=len(part_order))), lines)
    shapes = pa.ListArray.from_arrays(offsets(np.bincount(owner[part_order], minlength=rows)), parts)
    names = np.array([None, *WKB_TYPES.values()], object)[top]
    return pa.StructArray.from_arrays([pa.array(names, pa.string(), mask=~good), shapes], ["gtype", "parts"], mask=pa.array(~good)), good


@F.arrow_udf(GEOMETRY)
def _from_ewkb(values: pa.Array) -> pa.Array:
    return _read_ewkb(values)[0]


def from_ewkb_hex(text: Column) -> Column:
    """Hexadecimal extended well-known binary to a geometry; a broken value gives null."""
    return _from_ewkb(F.try_to_binary(text, F.lit("hex")))


def ewkb_error(text: Column, geom: Column) -> Column:
    """What is wrong with a hexadecimal value that gave no geometry; null where nothing is."""
    return F.when(text.isNotNull() & geom.isNull(), F.when(F.try_to_binary(text, F.lit("hex")).isNull(), "not hexadecimal").otherwise("not a whole geometry"))
