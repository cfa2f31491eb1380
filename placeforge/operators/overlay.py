"""The overlap of geometries with one constant area, as a geometry.

Both outlines are cut where they meet. The pieces of each that run inside the other, with those that both share in one
direction, bound the overlap, which lies to their left; followed from node to node they give its rings. Lines keep
their pieces inside the area, points those in it. Geometries far off, or wholly within a convex area, are told by their
boxes beforehand and do not reach the kernel. There all outlines of a batch are cut, and all pieces located, together.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeforge.functions.geometry import LINEAR, POLYGONAL, Area, bounds, near_box
from placeforge.operators.exact import DOUBT, meetings, turn
from placeforge.operators.kernels import decode_geometries, encode_geometries
from placeforge.operators.lines import PIXEL
from placeforge.schema import GEOMETRY

Point = tuple[float, float]
Edge = tuple[Point, Point]
_AT_ONCE = 1 << 17  # pairs of segments that are compared at once
_ROWS_AT_ONCE = 1024  # geometries that are cut together
_LONG_RING = 64  # beyond it a point is located by arrays
OVERLAP = T.StructType([T.StructField("kind", T.StringType()), T.StructField("geometry", GEOMETRY)])
NOTHING = "GEOMETRYCOLLECTION"  # kind of an overlap that is empty, or of parts of several dimensions


def _signed_area(ring: list[Point]) -> float:
    ox, oy = ring[0]
    return sum((p[0] - ox) * (q[1] - oy) - (q[0] - ox) * (p[1] - oy) for p, q in zip(ring, ring[1:])) / 2


def _signed_areas(xy: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``_signed_area`` of many rings, each ``count`` points from ``first`` on."""
    n = np.maximum(count - 1, 0)
    ring = np.repeat(np.arange(len(n)), n)
    at = first[ring] + np.arange(len(ring)) - (np.cumsum(n) - n)[ring]
    p, q = xy[at] - xy[first[ring]], xy[at + 1] - xy[first[ring]]
    left, right = p[:, 0] * q[:, 1], q[:, 0] * p[:, 1]
    found = np.bincount(ring, left - right, len(n)) / 2
    error = np.bincount(ring, np.abs(left) + np.abs(right), len(n)) * (n + 4) * 2.0**-53
    for k in np.flatnonzero(np.abs(found) <= error):
        if count[k]:
            found[k] = _signed_area(list(map(tuple, xy[first[k] : first[k] + count[k]].tolist())))
    return found


def _ring_edges(xy: np.ndarray, first: np.ndarray, count: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of many rings or lines, ``turned`` ones backwards, without those of no length; and the ring of each."""
    n = np.maximum(count - 1, 0)
    ring = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(ring)) - (np.cumsum(n) - n)[ring]
    back = turned[ring]
    at = first[ring] + np.where(back, n[ring] - step, step)
    edges = np.hstack([xy[at], xy[np.where(back, at - 1, at + 1)]])
    long_ = (edges[:, :2] != edges[:, 2:]).any(axis=1)
    return edges[long_], ring[long_]


def _area_edges(rings: list[list[Point]]) -> list[Edge]:
    """Edges of an area's rings with the inside to their left."""
    xy = np.array([p for r in rings for p in r], float)
    count = np.array([len(r) for r in rings])
    first = np.cumsum(count) - count
    edges, _ = _ring_edges(xy, first, count, (_signed_areas(xy, first, count) > 0) != (np.arange(len(rings)) == 0))
    return [((a, b), (c, d)) for a, b, c, d in edges.tolist()]


def _blocks(n: int, m: int) -> Iterator[slice]:
    step = max(1, _AT_ONCE // max(1, m))
    for first in range(0, n, step):
        yield slice(first, first + step)


def _cut(own: np.ndarray, area: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where edges of many outlines meet those of the area: (own edge, area's edge, is the cut on the area's, point)."""
    found = [(np.empty(0, int), np.empty(0, int), np.empty(0, bool), np.empty((0, 2)))]
    lo, hi = np.minimum(own[:, :2], own[:, 2:]), np.maximum(own[:, :2], own[:, 2:])
    lo_b, hi_b = np.minimum(area[:, :2], area[:, 2:]) - PIXEL, np.maximum(area[:, :2], area[:, 2:]) + PIXEL
    pairs, n = [], 0
    blocks = list(_blocks(len(own), len(area)))
    for some in blocks:
        i, j = np.nonzero(_boxes_meet(lo[some], hi[some], lo_b, hi_b))
        pairs.append((i + some.start, j))
        n += len(i)
        if n < _AT_ONCE and some is not blocks[-1]:
            continue
        i, j = (np.concatenate(v) for v in zip(*pairs))
        pairs, n = [], 0
        for held, which, x, y, _ in meetings(tuple(own[i].T), tuple(area[j].T), PIXEL):
            found.append((i[held], j[held], np.full(len(held), which == 1), np.column_stack([x, y])))
    return tuple(np.concatenate(v) for v in zip(*found))


def _boxes_meet(lo: np.ndarray, hi: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> np.ndarray:
    """Do boxes (rows) meet other boxes (columns)?"""
    met = (lo[:, :1] <= hi_b[:, 0]) & (lo_b[:, 0] <= hi[:, :1])
    met &= lo[:, 1:] <= hi_b[:, 1]
    met &= lo_b[:, 1] <= hi[:, 1:]
    return met


class _Ways:
    """Edges parted at their cuts: points in order (``xy``) with the edge of each, which are cuts, and where pieces begin."""

    def __init__(self, edges: np.ndarray, at: np.ndarray, cuts: np.ndarray):
        off = ((cuts - edges[at, :2]) ** 2).sum(axis=1)
        order = np.lexsort((cuts[:, 1], cuts[:, 0], off, at))
        at, cuts = at[order], cuts[order]
        new = _differs(at, cuts)
        at, cuts = at[new], cuts[new]
        n = np.bincount(at, minlength=len(edges))
        begin = 2 * np.arange(len(edges)) + np.cumsum(n) - n
        self.edge = np.repeat(np.arange(len(edges)), n + 2)
        self.xy = np.empty((len(self.edge), 2))
        self.xy[begin], self.xy[begin + 1 + n] = edges[:, :2], edges[:, 2:]
        between = np.arange(len(at)) + 2 * at + 1
        self.xy[between] = cuts
        self.is_cut = np.zeros(len(self.xy), bool)
        self.is_cut[between] = True
        self.piece = np.flatnonzero((self.edge[1:] == self.edge[:-1]) & (self.xy[1:] != self.xy[:-1]).any(axis=1))

    def middles(self, which: np.ndarray) -> np.ndarray:
        k = self.piece[which]
        return (self.xy[k] + self.xy[k + 1]) / 2


def _differs(key: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Which rows are not the row before."""
    found = np.ones(len(key), bool)
    found[1:] = (key[1:] != key[:-1]) | (points[1:] != points[:-1]).any(axis=1)
    return found


def _inside(points: np.ndarray, edges: list[Edge]) -> np.ndarray:
    """Are points, none of them on an edge, inside the rings?"""
    e = _array(edges)
    e = e[e[:, 1] != e[:, 3]]
    found = np.zeros(len(points), bool)
    for some in _blocks(len(points), len(e)):
        p = points[some]
        straddles = (e[:, 1] > p[:, 1:]) != (e[:, 3] > p[:, 1:])
        row, col = np.nonzero(straddles)
        side = turn(*e[col].T, p[row, 0], p[row, 1])
        right_of = (side > 0) == (e[col, 3] > e[col, 1])  # the edge is to the right of the point
        found[some] = np.bincount(row[right_of], minlength=len(p)) % 2 == 1
    return found


def _inside_own(points: np.ndarray, unit: np.ndarray, edges: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As ``_inside``, each point in the rings of its own unit; ``first`` is where the edges of each unit begin."""
    found = np.zeros(len(points), bool)
    count = np.diff(first)[unit]
    for some in np.split(np.arange(len(points)), np.flatnonzero(np.diff(np.cumsum(count) // _AT_ONCE)) + 1):
        n = count[some]
        k = np.repeat(some, n)
        e = edges[first[unit[k]] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)]
        straddles = (e[:, 1] > points[k, 1]) != (e[:, 3] > points[k, 1])
        k, e = k[straddles], e[straddles]
        right_of = (turn(*e.T, points[k, 0], points[k, 1]) > 0) == (e[:, 3] > e[:, 1])
        found[some] = (np.bincount(k[right_of], minlength=len(points)) % 2 == 1)[some]
    return found


def _array(pieces: list[Edge]) -> np.ndarray:
    return np.array([(*p, *q) for p, q in pieces], float).reshape(-1, 4)


def _holds(ring: list[Point], point: Point) -> bool:
    """``_inside`` for one point and one ring."""
    if len(ring) > _LONG_RING:
        return bool(_inside(np.array([point]), list(zip(ring, ring[1:])))[0])
    px, py = point
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > py) != (by > py):
            left, right = (bx - ax) * (py - ay), (by - ay) * (px - ax)
            side = left - right
            if abs(side) <= DOUBT * (abs(left) + abs(right)):
                side = turn(*(np.array([v]) for v in (ax, ay, bx, by, px, py)))[0]
            odd ^= (side > 0) == (by > ay)
    return odd


def _rings(edges: list[Edge]) -> list[list[Point]]:
    """Simple rings of edges with the inside to their left; a ring that meets itself in a point is parted there."""
    out = defaultdict(list)
    for p, q in edges:
        out[p].append(q)
    angle = lambda p, q: math.atan2(q[1] - p[1], q[0] - p[0])
    found = []
    left = {(p, q) for p, q in edges}
    for start in edges:
        if start not in left:
            continue
        walk, (p, q) = [start[0]], start
        seen = {start[0]: 0}
        while True:
            left.discard((p, q))
            if q in seen:  # a loop ends here
                first = seen[q]
                found.append([*walk[first:], q])
                for c in walk[first + 1 :]:
                    del seen[c]
                del walk[first + 1 :]
            else:
                seen[q] = len(walk)
                walk.append(q)
            ahead = [r for r in out[q] if (q, r) in left]
            if not ahead:
                break
            if len(ahead) == 1:
                p, q = q, ahead[0]
                continue
            # the next one clockwise from the way back keeps to the same face
            back = angle(q, p)
            p, q = q, min(ahead, key=lambda r: (back - angle(q, r)) % (2 * math.pi) or 2 * math.pi)  # noqa: B023
    return [r for r in found if len(r) > 3]


def _cycles(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of edges that each have one after them: all of them ring by ring, and the rings' sizes; rings begin at their first edge."""
    number = np.arange(len(a))
    from_node = np.empty(n, int)
    from_node[a] = number
    least, ahead = number, from_node[b]
    back = np.empty_like(number)
    back[ahead] = number
    while (lower := np.minimum(least, least[ahead])).tobytes() != least.tobytes():
        least, ahead = lower, ahead[ahead]
    begins = least == number
    back = np.where(begins, number, back)
    steps = (~begins).astype(int)
    while not begins[back].all():
        steps, back = steps + steps[back], back[back]
    return np.lexsort((steps, least)), np.bincount(least, minlength=len(a))[begins]


def _shared_rings(unit: np.ndarray, a: np.ndarray, b: np.ndarray, xy: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """``_rings`` of many units, ``a`` and ``b`` the ends of edges in ``xy``, whose points belong to one unit; and the unit of each."""
    once = np.sort(np.unique(a * len(xy) + b, return_index=True)[1])
    unit, a, b = unit[once], a[once], b[once]
    out, into = np.bincount(a, minlength=len(xy)), np.bincount(b, minlength=len(xy))
    odd = np.zeros(unit.max(initial=-1) + 1, bool)  # with a point where several ways go on, or none
    odd[unit[(out[a] != 1) | (into[a] != 1) | (out[b] != 1) | (into[b] != 1)]] = True
    plain = ~odd[unit]
    order, size = _cycles(a[plain], b[plain], len(xy))
    start, of = a[plain][order], unit[plain][order]
    first = np.cumsum(size) - size
    kept = size > 2
    pts = xy[start]
    found = [np.concatenate([pts[k : k + n], pts[k : k + 1]]) for k, n in zip(first[kept].tolist(), size[kept].tolist())]
    units = of[first[kept]]
    if odd.any():
        left = np.flatnonzero(~plain)
        more = []
        for some in np.split(left, np.flatnonzero(np.diff(unit[left])) + 1):
            ends = zip(map(tuple, xy[a[some]].tolist()), map(tuple, xy[b[some]].tolist()))
            rings = _rings(list(ends))
            found += [np.array(r) for r in rings]
            more += [unit[some[0]].item()] * len(rings)
        units = np.r_[units, np.array(more, int)]
    return found, units


def _polygons(rings: list[np.ndarray], unit: np.ndarray) -> dict[int, list[list[np.ndarray]]]:
    """Shells with their holes, by unit; shells by ascending area."""
    found: dict[int, list[list[np.ndarray]]] = defaultdict(list)
    if not rings:
        return found
    count = np.array([len(r) for r in rings])
    xy, first = np.concatenate(rings), np.cumsum(count) - count
    area = _signed_areas(xy, first, count)
    lo, hi = np.minimum.reduceat(xy, first).tolist(), np.maximum.reduceat(xy, first).tolist()
    shells = defaultdict(list)
    order = np.lexsort((area, unit))
    for k, u in zip((ks := order[area[order] > 0]).tolist(), unit[ks].tolist()):
        found[u].append([rings[k]])
        shells[u].append(k)
    for h in np.flatnonzero(area < 0).tolist():
        u = unit[h].item()
        hole = None
        for part, k in zip(found[u] if u in found else [], shells[u]):  # the smallest that holds it
            if lo[h][0] > hi[k][0] or lo[k][0] > hi[h][0] or lo[h][1] > hi[k][1] or lo[k][1] > hi[h][1]:
                continue
            hole = hole or list(map(tuple, rings[h].tolist()))
            shell = list(map(tuple, rings[k].tolist()))
            corners = set(shell)
            at = next((c for c in hole if c not in corners), None)
            if _holds(shell, at if at else ((hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2)):
                part.append(rings[h])
                break
    return found


def _runs(unit: np.ndarray, a: np.ndarray, b: np.ndarray, xy: np.ndarray) -> dict[int, list[np.ndarray]]:
    """Consecutive pieces of a unit as lines; one that goes on where the unit's first begins is its start."""
    found: dict[int, list[np.ndarray]] = defaultdict(list)
    if not len(a):
        return found
    begins = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (a[1:] != b[:-1])])
    ends = np.r_[begins[1:], len(a)]
    run = np.repeat(np.arange(len(begins)), ends - begins)
    way = np.empty(len(a) + len(begins), int)
    way[np.arange(len(a)) + run], way[ends + np.arange(len(begins))] = a, b[ends - 1]
    pts = xy[way]
    for k, (u, i, j) in enumerate(zip(unit[begins].tolist(), begins.tolist(), ends.tolist())):
        found[u].append(pts[i + k : j + k + 1])
    for lines in found.values():
        if len(lines) > 1 and (lines[-1][-1] == lines[0][0]).all():
            lines[0] = np.concatenate([lines.pop(), lines[0][1:]])
    return found


def _snapped(pts: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """Points a hair off a corner of the area are that corner."""
    pts = pts.copy()
    lo, hi = corners.min(axis=0) - PIXEL, corners.max(axis=0) + PIXEL
    near = np.flatnonzero(((pts >= lo) & (pts <= hi)).all(axis=1))
    for some in _blocks(len(near), len(corners)):
        k = near[some]
        off = np.maximum(np.abs(corners[:, 0] - pts[k, :1]), np.abs(corners[:, 1] - pts[k, 1:]))
        hit = np.flatnonzero((off <= PIXEL).any(axis=1))
        pts[k[hit]] = corners[off[hit].argmin(axis=1)]
    return pts


class _Shared(NamedTuple):
    """What outlines share with the area, by outline; ``nodes`` are (outline, point), touched by both, or covered by the other two."""

    polygons: dict[int, list[list[np.ndarray]]]
    lines: dict[int, list[np.ndarray]]
    unit: np.ndarray
    nodes: np.ndarray
    touched: np.ndarray
    covered: np.ndarray


def _share(own: np.ndarray, unit: np.ndarray, polygonal: np.ndarray, area_edges: list[Edge]) -> _Shared:
    """What each outline shares with the area; of a polygon, lines and points where only outlines touch.

    ``own`` are the edges of all outlines, ``unit`` the outline of each in ascending order.
    """
    area = _array(area_edges)
    first = np.searchsorted(unit, np.arange(len(polygonal) + 1))
    i, j, on_area, cuts = _cut(own, area)
    # only edges near an outline can meet it or lie within it
    some = np.flatnonzero(np.diff(first))
    lo, hi = np.full((len(polygonal), 2), np.inf), np.full((len(polygonal), 2), -np.inf)
    if len(some):
        lo[some] = np.minimum.reduceat(np.minimum(own[:, :2], own[:, 2:]), first[some]) - 4 * PIXEL
        hi[some] = np.maximum.reduceat(np.maximum(own[:, :2], own[:, 2:]), first[some]) + 4 * PIXEL
    near = _boxes_meet(lo, hi, np.minimum(area[:, :2], area[:, 2:]), np.maximum(area[:, :2], area[:, 2:]))
    near_unit, near_edge = np.nonzero(near)
    number = np.full(near.shape, -1)
    number[near_unit, near_edge] = np.arange(len(near_unit))
    of_near = number[unit[i[on_area]], j[on_area]]
    mine = _Ways(own, i[~on_area], cuts[~on_area])
    theirs = _Ways(area[near_edge], of_near[of_near >= 0], cuts[on_area][of_near >= 0])

    # points of one outline get one number
    of_point = np.r_[unit[mine.edge], near_unit[theirs.edge]]
    xy = np.concatenate([mine.xy, theirs.xy])
    order = np.lexsort((xy[:, 1], xy[:, 0], of_point))
    new = _differs(of_point[order], xy[order])
    node = np.empty(len(xy), int)
    node[order] = np.cumsum(new) - 1
    nodes, node_unit = xy[order][new], of_point[order][new]
    of_mine, of_theirs = node[: len(mine.xy)], node[len(mine.xy) :]
    a, b, u = of_mine[mine.piece], of_mine[mine.piece + 1], unit[mine.edge[mine.piece]]
    c, d, v = of_theirs[theirs.piece], of_theirs[theirs.piece + 1], near_unit[theirs.edge[theirs.piece]]
    n = len(nodes)
    along, against = np.isin(a * n + b, c * n + d), np.isin(b * n + a, c * n + d)
    of_polygon = polygonal[u]
    alone = np.flatnonzero(~(of_polygon & (along | against)))
    other = np.flatnonzero(polygonal[v] & ~np.isin(c * n + d, a * n + b) & ~np.isin(d * n + c, a * n + b))
    held = np.zeros(len(a), bool)
    held[alone] = _inside(mine.middles(alone), area_edges)
    other = other[_inside_own(theirs.middles(other), v[other], own, first)]

    on_line = ~of_polygon & (held | along | against)
    along, against, held = of_polygon & along, of_polygon & against, of_polygon & held  # along: both lie to the left
    edges = [np.concatenate([x[along], x[held], y[other]]) for x, y in ((u, v), (a, c), (b, d))]
    by_unit = np.argsort(edges[0], kind="stable")
    bound = [e[by_unit] for e in edges]
    lines = against | on_line

    flag = lambda *some: np.isin(np.arange(n), np.concatenate(some))
    touched = flag(of_mine[mine.is_cut], of_theirs[theirs.is_cut]) | (flag(of_mine[~mine.is_cut]) & flag(of_theirs[~theirs.is_cut]))
    covered = flag(bound[1], bound[2], a[lines], b[lines])
    return _Shared(_polygons(*_shared_rings(*bound, nodes)), _runs(u[lines], a[lines], b[lines], nodes), node_unit, nodes, touched, covered)


def _points_held(points: np.ndarray, area_edges: list[Edge]) -> np.ndarray:
    """Are points inside the area or on its outline?"""
    held, e = _inside(points, area_edges), _array(area_edges)
    for some in _blocks(len(points), len(e)):
        p = points[some, None]
        near, edge = np.nonzero(((np.minimum(e[:, :2], e[:, 2:]) <= p) & (np.maximum(e[:, :2], e[:, 2:]) >= p)).all(axis=2))
        at = points[some][near]
        held[some.start + near[turn(*e[edge].T, at[:, 0], at[:, 1]) == 0]] = True
    return held


def _touching(xy: np.ndarray, ring: np.ndarray, owner: np.ndarray, polygonal: np.ndarray, area_edges: list[Edge], corner: Point) -> np.ndarray:
    """``geometry.intersects`` for many geometries: of points with the number of their ring, and the owner of each ring."""
    e = _array(area_edges)
    found = np.zeros(len(polygonal), bool)

    def ray_hits(x0, y0, x1, y1, px, py):
        rise = y1 - y0
        return ((y0 > py) != (y1 > py)) & (px < x0 + (py - y0) / np.where(rise == 0, 1.0, rise) * (x1 - x0))

    def on_segment(x0, y0, x1, y1, px, py):
        cross = (x1 - x0) * (py - y0) - (y1 - y0) * (px - x0)
        near = (np.minimum(x0, x1) <= px) & (px <= np.maximum(x0, x1)) & (np.minimum(y0, y1) <= py) & (py <= np.maximum(y0, y1))
        return near & (cross == 0)

    lo_e, hi_e = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    within = np.flatnonzero(((xy >= lo_e.min(axis=0)) & (xy <= hi_e.max(axis=0))).all(axis=1))
    for some in _blocks(len(within), len(e)):
        k = within[some]
        px, py = xy[k, 0], xy[k, 1]
        i, j = np.nonzero((e[:, 1] > py[:, None]) != (e[:, 3] > py[:, None]))
        held = np.bincount(i[ray_hits(*e[j].T, px[i], py[i])], minlength=len(k)) % 2 == 1
        i, j = np.nonzero(_boxes_meet(xy[k], xy[k], lo_e, hi_e))
        held[i[on_segment(*e[j].T, px[i], py[i])]] = True
        found[owner[ring[k[held]]]] = True
    # segments; a ring of one point is one of no length
    single = np.bincount(ring, minlength=len(owner))[ring] == 1
    start = np.flatnonzero(np.r_[(ring[1:] == ring[:-1]), False] | single)
    seg = np.hstack([xy[start], xy[np.where(single[start], start, start + 1)]])
    of_seg = owner[ring[start]]
    x0, y0, x1, y1 = seg.T
    around = np.bincount(of_seg[ray_hits(x0, y0, x1, y1, *corner)], minlength=len(found)) % 2 == 1
    around[of_seg[on_segment(x0, y0, x1, y1, *corner)]] = True
    found |= around & polygonal
    left = ~found[of_seg]
    seg, of_seg = seg[left], of_seg[left]
    sign = lambda a, b, p: np.sign((b[:, 0] - a[:, 0]) * (p[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (p[:, 0] - a[:, 0]))
    for some in _blocks(len(seg), len(e)):
        lo, hi = np.minimum(seg[some, :2], seg[some, 2:]), np.maximum(seg[some, :2], seg[some, 2:])
        i, j = np.nonzero(_boxes_meet(lo, hi, lo_e, hi_e))
        a, b, c, d = seg[some][i, :2], seg[some][i, 2:], e[j, :2], e[j, 2:]
        meet = (sign(a, b, c) * sign(a, b, d) <= 0) & (sign(c, d, a) * sign(c, d, b) <= 0)
        found[of_seg[some][i[meet]]] = True
    return found


def _overlaps(geoms: list, area_rings: list[list[Point]]) -> list:
    """(kind, geometry) of each (gtype, parts) or None; the geometry is of the largest dimension that the overlap has."""
    edges = _area_edges(area_rings)
    corners = np.array([p for p, _ in edges], float)
    found: list = [g and (NOTHING, None) for g in geoms]
    present = [n for n, g in enumerate(geoms) if g and any(len(r) for part in g[1] for r in part)]
    rings = [(k, r, inner) for k, n in enumerate(present) for part in geoms[n][1] for inner, r in enumerate(part)]
    if not rings:
        return found
    xy = np.concatenate([r for _, r, _ in rings])
    count, owner = np.array([len(r) for _, r, _ in rings]), np.array([k for k, _, _ in rings])
    inner = np.array([n > 0 for _, _, n in rings])
    first = np.cumsum(count) - count
    polygonal = np.array([geoms[n][0] in POLYGONAL for n in present])
    linear = np.array([geoms[n][0] in LINEAR for n in present])
    outline = [(p, q) for r in area_rings for p, q in zip(r, r[1:])]
    touching = _touching(xy, np.repeat(np.arange(len(rings)), count), owner, polygonal, outline, area_rings[0][0])
    xy = _snapped(xy, corners)

    # a polygonal geometry is one outline, each line of a linear one is its own
    taken = touching[owner] & (count > 0) & (polygonal[owner] | (linear[owner] & ~inner))
    begins = taken & linear[owner]
    begins[np.flatnonzero(taken)[_differs(owner[taken], np.empty((taken.sum(), 0)))]] = True
    of_unit = owner[begins]
    unit = np.cumsum(begins)[taken] - 1
    turned = np.zeros(taken.sum(), bool)
    shells = polygonal[owner[taken]]
    turned[shells] = (_signed_areas(xy, first[taken][shells], count[taken][shells]) > 0) == inner[taken][shells]
    own, of_ring = _ring_edges(xy, first[taken], count[taken], turned)
    shared: dict[int, list] = defaultdict(lambda: [[], [], []])
    if len(of_unit):
        some = _share(own, unit[of_ring], polygonal[of_unit], edges)
        rows = of_unit.tolist()
        for u, polygons in some.polygons.items():
            shared[rows[u]][0] = polygons
        for u in sorted(some.lines):
            shared[rows[u]][1] += some.lines[u]
        bare = np.flatnonzero(some.touched & ~some.covered)
        several = np.bincount(of_unit, minlength=len(present)) > 1  # what one line covers is covered
        of_node = of_unit[some.unit]
        hidden = np.flatnonzero(several[of_node] & some.covered)
        covered = set(zip(of_node[hidden].tolist(), map(tuple, some.nodes[hidden].tolist())))
        for k, p in sorted(set(zip(of_node[bare].tolist(), map(tuple, some.nodes[bare].tolist()))) - covered):
            shared[k][2].append(p)
    at = np.flatnonzero(touching[owner] & ~polygonal[owner] & ~linear[owner] & ~inner)
    if len(at):
        points = xy[first[at]]
        for k, p in zip(owner[(held := at[_points_held(points, edges)])].tolist(), map(tuple, xy[first[held]].tolist())):
            shared[k][2].append(p)
    for k, (polygons, lines, points) in shared.items():
        shapes = (("POLYGON", polygons), ("LINESTRING", [[line] for line in lines]), ("POINT", [[np.array([p])] for p in points]))
        kinds = [(name if len(s) == 1 else f"MULTI{name}", s) for name, s in shapes if s]
        if kinds:
            found[present[k]] = (kinds[0][0] if len(kinds) == 1 else NOTHING), kinds[0]
    return found


def overlap(geom: Column, area_: Area) -> Column:
    """struct(kind, geometry): what a geometry shares with the area.

    ``kind`` tells one part from several, and is GEOMETRYCOLLECTION when nothing is shared, or parts of several
    dimensions (a polygon that crosses the area and touches it elsewhere); the geometry then has those of the largest.
    ``geom`` must be a column, not an expression with lambdas, as for all Arrow kernels.
    """

    @F.arrow_udf(OVERLAP)
    def clipped(geoms: pa.Array) -> pa.Array:
        left, rows = decode_geometries(geoms), []
        while some := list(islice(left, _ROWS_AT_ONCE)):
            rows += _overlaps(some, area_.rings)
        kinds = pa.array([r and r[0] for r in rows], pa.string())
        return pa.StructArray.from_arrays([kinds, encode_geometries([r and r[1] for r in rows])], ["kind", "geometry"])

    whole = F.lit(False)
    if area_.is_convex():  # of a single part, it is its own overlap
        box = bounds(geom)
        turned = 1 if _signed_area(area_.rings[0]) > 0 else -1
        corners_of = [(box[x], box[y]) for x in ("minx", "maxx") for y in ("miny", "maxy")]
        whole = F.lit(True)
        for p, q in zip(area_.rings[0], area_.rings[0][1:]):
            for x, y in corners_of:
                whole = whole & (turned * ((q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0])) > 0)
    near = near_box(geom, area_)
    own = F.struct(geom["gtype"].alias("kind"), geom.alias("geometry")).cast(OVERLAP)
    none = F.struct(F.lit(NOTHING).alias("kind"), F.lit(None).cast(GEOMETRY).alias("geometry")).cast(OVERLAP)
    single = geom["gtype"].isin("POINT", "LINESTRING", "POLYGON")
    found = clipped(F.when(near & ~(whole & single), geom))
    return F.when(geom.isNull(), None).when(~near, none).when(whole & single, own).otherwise(found)
