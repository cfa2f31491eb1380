"""Objects within a distance of each other, for a batch of leaves that each fit in memory, by arrays and union-find.

A leaf's segments are cut at a grid whose cells are small enough that all that lies in one cell belongs together.
Neighbouring cells are told by the boxes of what they hold, and segment by segment only where boxes leave it open and
the cells are not in one component yet; an object's first point is looked up in the polygons whose box holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SIDE = 0.7  # cell side per distance: the diagonal is 0.99 of it
_AT_ONCE = 1 << 17  # pairs of segments that are compared at once
BATCH = 100_000  # segments of leaves that are solved together


def components(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest node of each node's component; ``label`` has components that are already known."""
    label = np.arange(n) if label is None else label.copy()
    while len(u):
        a, b = label[u], label[v]
        open_ = a != b
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        if not len(u):
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _cut(seg: np.ndarray, side: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, part (x0, y0, x1, y1), cell) of segments cut at the grid."""
    owners, shares = [np.arange(len(seg)), np.arange(len(seg))], [np.zeros(len(seg)), np.ones(len(seg))]
    for p, q in ((seg[:, 0], seg[:, 2]), (seg[:, 1], seg[:, 3])):
        lo, hi = np.floor(np.minimum(p, q) / side) + 1, np.floor(np.maximum(p, q) / side)
        count = np.maximum(hi - lo + 1, 0).astype(np.int64)
        own = np.repeat(np.arange(len(seg)), count)
        line = lo[own] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owners.append(own)
        shares.append((line * side - p[own]) / (q[own] - p[own]))
    own, share = np.concatenate(owners), np.clip(np.concatenate(shares), 0.0, 1.0)
    order = np.lexsort((share, own))
    own, share = own[order], share[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (share[1:] != share[:-1])
    own, share = own[new], share[new]
    part = np.flatnonzero(own[1:] == own[:-1])
    own, s, t = own[part], share[part][:, None], share[part + 1][:, None]
    a, b = seg[own, :2], seg[own, 2:]
    parts = np.hstack([a + s * (b - a), np.where(t == 1, b, a + t * (b - a))])
    cells = np.floor((parts[:, :2] + parts[:, 2:]) / 2 / side).astype(np.int64)
    return own, parts, cells


def _point_segment(px, py, s) -> np.ndarray:
    dx, dy = s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]
    norm = dx * dx + dy * dy
    t = np.clip(((px - s[:, 0]) * dx + (py - s[:, 1]) * dy) / np.where(norm > 0, norm, 1.0), 0.0, 1.0)
    return (px - s[:, 0] - t * dx) ** 2 + (py - s[:, 1] - t * dy) ** 2


def segment_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the distances between segments, pair by pair."""

    def side(s, px, py):
        return np.sign((s[:, 2] - s[:, 0]) * (py - s[:, 1]) - (s[:, 3] - s[:, 1]) * (px - s[:, 0]))

    crossing = (side(a, b[:, 0], b[:, 1]) * side(a, b[:, 2], b[:, 3]) < 0) & (side(b, a[:, 0], a[:, 1]) * side(b, a[:, 2], a[:, 3]) < 0)
    nearest = np.minimum(
        np.minimum(_point_segment(a[:, 0], a[:, 1], b), _point_segment(a[:, 2], a[:, 3], b)),
        np.minimum(_point_segment(b[:, 0], b[:, 1], a), _point_segment(b[:, 2], b[:, 3], a)),
    )
    return np.where(crossing, 0.0, nearest)


def _neighbours(leaf: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cells of a leaf that can be near: each with half of those two around it."""
    wide, high = np.int64(cx.max() - cx.min() + 5), np.int64(cy.max() - cy.min() + 5)
    if float(leaf.max() + 1) * wide * high < 2**62:
        key = lambda l, x, y: (l * wide + (x - cx.min() + 2)) * high + (y - cy.min() + 2)
        own = key(leaf, cx, cy)
        order = np.argsort(own)
        own = own[order]
        left, right = [], []
        for dx in range(-2, 3):
            for dy in range(-2, 3):
                if (dx, dy) > (0, 0):
                    wanted = key(leaf, cx + dx, cy + dy)
                    at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                    hit = np.flatnonzero(own[at] == wanted)
                    left.append(hit)
                    right.append(order[at[hit]])
        return np.concatenate(left), np.concatenate(right)
    # cells too far apart for one number: columns of cells first
    at = {}
    for i, k in enumerate(zip(leaf.tolist(), cx.tolist(), cy.tolist())):
        at[k] = i
    offsets = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    pairs = [(i, at[l, x + dx, y + dy]) for (l, x, y), i in at.items() for dx, dy in offsets if (l, x + dx, y + dy) in at]
    return tuple(np.array(pairs, np.int64).reshape(-1, 2).T)


def _in_polygons(label: np.ndarray, leaf, obj, first, seg, of_polygon, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of polygons with objects whose first point they hold, where the two are not in one component."""
    some = np.flatnonzero(of_polygon)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    some = some[np.argsort(obj[some], kind="stable")]
    edges = np.append(np.flatnonzero(np.r_[True, obj[some][1:] != obj[some][:-1]]), len(some))
    # objects by leaf and x
    own_leaf = np.zeros(n, np.int64)
    own_leaf[obj] = leaf
    order = np.lexsort((first[:, 0], own_leaf))
    leaves, xs = own_leaf[order], first[order, 0]
    u, v = [], []
    for a, b in zip(edges, edges[1:]):
        rows = some[a:b]
        polygon, s = obj[rows[0]], seg[rows]
        x, y = s[:, [0, 2]], s[:, [1, 3]]
        lo, hi = np.searchsorted(leaves, own_leaf[polygon], "left"), np.searchsorted(leaves, own_leaf[polygon], "right")
        lo, hi = lo + np.searchsorted(xs[lo:hi], x.min(), "left"), lo + np.searchsorted(xs[lo:hi], x.max(), "right")
        held = order[lo:hi]
        held = held[(label[held] != label[polygon]) & (first[held, 1] >= y.min()) & (first[held, 1] <= y.max())]
        step = max(1, _AT_ONCE // len(s))
        for k in range(0, len(held), step):
            p = first[held[k : k + step]]
            straddles = (s[:, 1] > p[:, 1:]) != (s[:, 3] > p[:, 1:])
            row, col = np.nonzero(straddles)
            x_at = s[col, 0] + (p[row, 1] - s[col, 1]) / (s[col, 3] - s[col, 1]) * (s[col, 2] - s[col, 0])
            inside = np.bincount(row[p[row, 0] < x_at], minlength=len(p)) % 2 == 1
            found = held[k : k + step][inside]
            u.append(np.full(len(found), polygon))
            v.append(found)
    return np.concatenate(u or [np.zeros(0, np.int64)]), np.concatenate(v or [np.zeros(0, np.int64)])


def _near_cells(l: np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray, seg: np.ndarray, own: np.ndarray, eps: float) -> np.ndarray:
    """Which of the pairs of cells hold segments within the distance: ``_AT_ONCE`` tests in all, or one pair of more."""
    if len(l) == 1:  # perhaps two crowded cells: part of one against all of the other at a time
        others = seg[own[start[r[0]] : start[r[0]] + size[r[0]]]]
        step = max(1, int(_AT_ONCE // len(others)))
        for first in range(start[l[0]], start[l[0]] + size[l[0]], step):
            some = seg[own[first : min(first + step, start[l[0]] + size[l[0]])]]
            if (segment_distances(np.repeat(some, len(others), axis=0), np.tile(others, (len(some), 1))) <= eps * eps).any():
                return np.zeros(1, np.int64)
        return np.zeros(0, np.int64)
    tests = size[l] * size[r]
    pair = np.repeat(np.arange(len(l)), tests)
    within = np.arange(len(pair)) - np.repeat(np.cumsum(tests) - tests, tests)
    i, j = start[l[pair]] + within // size[r[pair]], start[r[pair]] + within % size[r[pair]]
    return np.unique(pair[segment_distances(seg[own[i]], seg[own[j]]) <= eps * eps])


def solve(leaf: np.ndarray, obj: np.ndarray, number: np.ndarray, seg: np.ndarray, of_polygon: np.ndarray, eps: float) -> np.ndarray:
    """The component of each object 0, 1, ... of segments (x0, y0, x1, y1); ``number`` 0 marks an object's first."""
    n, side = int(obj.max()) + 1, eps * _SIDE
    own, parts, cells = _cut(seg, side)
    owner = obj[own]
    order = np.lexsort((cells[:, 1], cells[:, 0], leaf[own]))
    own, owner, parts, cells = own[order], owner[order], parts[order], cells[order]
    key = np.column_stack([leaf[own], cells])
    start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
    size = np.diff(np.append(start, len(own)))
    label = components(n, owner, np.repeat(owner[start], size))
    lo = np.minimum.reduceat(np.minimum(parts[:, :2], parts[:, 2:]), start)
    hi = np.maximum.reduceat(np.maximum(parts[:, :2], parts[:, 2:]), start)
    left, right = _neighbours(*key[start].T)
    gap = np.maximum(0.0, np.maximum(lo[left] - hi[right], lo[right] - hi[left]))
    span = np.maximum(hi[left] - lo[right], hi[right] - lo[left])
    near = (gap**2).sum(axis=1) <= eps * eps
    sure = near & ((span**2).sum(axis=1) <= eps * eps)
    first_owner = owner[start]
    label = components(n, first_owner[left[sure]], first_owner[right[sure]], label)
    left, right = left[near & ~sure], right[near & ~sure]
    while len(left):
        apart = label[first_owner[left]] != label[first_owner[right]]
        left, right = left[apart], right[apart]
        work = np.cumsum(size[left] * size[right])
        at, most = 0, max(len(left), _AT_ONCE)  # tests before all that is left is looked at again
        while at < len(left) and (at == 0 or work[at - 1] < most):
            upto = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + _AT_ONCE, "right")))
            l, r = left[at:upto], right[at:upto]
            at = upto
            open_ = label[first_owner[l]] != label[first_owner[r]]
            l, r = l[open_], r[open_]
            if len(l):
                hit = _near_cells(l, r, start, size, seg, own, eps)
                label = components(n, first_owner[l[hit]], first_owner[r[hit]], label)
        left, right = left[at:], right[at:]
    first = np.zeros((n, 2))
    first[obj[number == 0]] = seg[number == 0, :2]
    return components(n, *_in_polygons(label, leaf, obj, first, seg, of_polygon, n), label)


def solve_batches(batches: Iterator[pa.RecordBatch], eps: float) -> Iterator[pa.RecordBatch]:
    """Rows (nk, space, place_id, n, of_polygon, x0, y0, x1, y1) sorted by (nk, space) to (node, component)."""

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held)
        column = lambda name: whole.column(name).to_numpy()
        name = whole.column("nk").combine_chunks().dictionary_encode().indices.to_numpy()
        _, leaf = np.unique(np.column_stack([name, column("space")]), axis=0, return_inverse=True)
        ids, obj = np.unique(column("place_id"), return_inverse=True)
        seg = np.column_stack([column(c) for c in ("x0", "y0", "x1", "y1")])
        label = solve(leaf.ravel(), obj, column("n"), seg, column("of_polygon").astype(bool), eps)
        linked = np.bincount(label, minlength=len(ids))[label] > 1
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], ["node", "component"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        first = 0
        if size + batch.num_rows > BATCH:
            # the rows of the last leaf of what is held may go on in the batch
            names, spaces = batch.column("nk").to_pylist(), batch.column("space").to_pylist()
            last = (held[-1].column("nk")[-1].as_py(), held[-1].column("space")[-1].as_py()) if held else (names[0], spaces[0])
            for i, now in enumerate(zip(names, spaces)):
                if now != last:
                    last = now
                    if size + i - first > BATCH:
                        held.append(batch.slice(first, i - first))
                        yield answer(held)
                        held, size, first = [], 0, i
        if first < batch.num_rows:
            held.append(batch.slice(first))
            size += batch.num_rows - first
    if held:
        yield answer(held)
