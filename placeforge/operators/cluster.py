"""Clusters of same-name objects within a distance, as components of "nearer than eps".

Distances are planar in EPSG:3857, so a cluster shrinks on the ground with the latitude.

Arrays are unfolded with the outer forms of explode and inline, though none is empty: the plain forms
make Spark evaluate the array twice, once to test its size.

Objects are first parted into leaves that no link leaves: a name of few points is one, and an object of a common name
lies with all whose boxes, widened by half the distance, share a square with its own, directly or through others:
wide squares first, and smaller ones (``_SQUARES``) for what these leave together. A leaf of at most ``_LEAF`` points is
solved in one pass over its segments (see ``leaves``), which are shuffled once. What is left, names crowded over wide
regions, is spread by cells as follows.

Geometries are cut at the lines of a grid whose cells are small enough that all that lies in one cell
belongs together. That leaves three kinds of links, none of which needs pairs of objects:
objects of one cell (a star per cell), neighbouring cells (decided from boxes, see ``_open_links``) and
objects inside a polygon (runs of interior cells, looked up by cell).
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions.geometry import POLYGONAL, bounds, mercator_x, mercator_y, num_points, segments
from placeforge.functions.text import unaccent
from placeforge.operators.components import connected_components
from placeforge.operators.leaves import solve_batches
from placeforge.operators.skew import with_groups
from placeforge.session import durable

DEFAULT_EPS = 100.0  # units of EPSG:3857: metres at the equator
_SIDE = 0.7  # cell side per eps; the diagonal is 0.99 eps
_SPLIT = 8  # a crowded cell is looked at again as 8 x 8 cells
_TESTS = 4096  # pieces of two cells are compared directly up to this many pairs
_TESTS_PER_PIECE = 32  # with more comparisons than this to make, components are found in two steps
_MAX_DEPTH = 12  # cells of eps / 8^12 are below the spacing of doubles

_LEAF = 20_000  # points of a leaf that one task solves
_SQUARES = (20, 2)  # sides of the squares by which a common name, and then what is left too large, is parted, per eps
_MOST_SQUARES = 1024  # a name, or what is left of it, with an object over more squares is not parted

_CELL = ["nk", "cx", "cy"]
_LINE = ["x0", "y0", "x1", "y1"]  # the whole segment
_CUT = ["a0", "b0", "a1", "b1"]  # its part inside the cell


def _mercator_segments(rows: DataFrame) -> DataFrame:
    x0, y0, x1, y1 = (F.col(f"s.{n}") for n in _LINE)
    return rows.select("place_id", "nk", F.explode_outer(segments(F.col("geometry"))).alias("s")).select(
        "place_id", "nk",
        mercator_x(x0).alias("x0"), mercator_y(y0).alias("y0"),
        mercator_x(x1).alias("x1"), mercator_y(y1).alias("y1"),
    )


def _grid_cuts(p: Column, q: Column, side: float) -> Column:
    """Where the way from p to q meets grid lines, as shares of the way."""
    lo, hi = F.floor(F.least(p, q) / side) + 1, F.floor(F.greatest(p, q) / side)
    none = F.array().cast("array<bigint>")
    lines = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    return F.transform(lines, lambda k: (k * F.lit(side) - p) / (q - p))


def _cut_to_cells(pieces: DataFrame, side: float) -> DataFrame:
    """Each piece ``a0 b0 a1 b1`` cut at the grid, with the cell ``cx, cy`` of every part."""
    a0, b0, a1, b1 = map(F.col, _CUT)
    ends = F.array(F.lit(0.0), F.lit(1.0))
    cuts = F.array_sort(F.array_distinct(F.concat(ends, _grid_cuts(a0, a1, side), _grid_cuts(b0, b1, side))))
    spans = F.zip_with(
        F.slice("cuts", F.lit(1), F.size("cuts") - 1),
        F.slice("cuts", F.lit(2), F.size("cuts") - 1),
        lambda s, t: F.struct(s.alias("s"), t.alias("t")),
    )
    s, t = F.col("w.s"), F.col("w.t")

    def at(p: Column, q: Column, share: Column) -> Column:
        return F.when(share == 0, p).when(share == 1, q).otherwise(p + share * (q - p))

    rest = [c for c in pieces.columns if c not in (*_CUT, "cx", "cy")]
    parts = pieces.withColumn("cuts", cuts).select(*rest, *_CUT, F.explode_outer(spans).alias("w"))

    def cell(p: Column, q: Column, axis: str) -> Column:
        """The cell of a part's middle; inside the cell that is being cut up, if there is one."""
        index = F.floor((at(p, q, s) + at(p, q, t)) / 2 / side)
        if "up" not in rest:
            return index
        first = F.col(f"up.{axis}") * _SPLIT
        return F.least(F.greatest(index, first), first + (_SPLIT - 1))

    return parts.select(
        *rest,
        cell(a0, a1, "cx").alias("cx"),
        cell(b0, b1, "cy").alias("cy"),
        at(a0, a1, s).alias("a0"), at(b0, b1, s).alias("b0"),
        at(a0, a1, t).alias("a1"), at(b0, b1, t).alias("b1"),
    )


def _boxes(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Per cell: its smallest object, number of pieces and the box they fill."""
    return pieces.groupBy(*keys).agg(
        F.min("place_id").alias("rep"),
        F.count("*").alias("n"),
        F.min(F.least("a0", "a1")).alias("lox"), F.min(F.least("b0", "b1")).alias("loy"),
        F.max(F.greatest("a0", "a1")).alias("hix"), F.max(F.greatest("b0", "b1")).alias("hiy"),
    )


def _square(v: Column) -> Column:
    return v * v


def _box_distances(l: str, r: str) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance between points of two boxes."""

    def col(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def gap(axis: str) -> Column:
        return F.greatest(
            F.lit(0.0), col(l, f"lo{axis}") - col(r, f"hi{axis}"), col(r, f"lo{axis}") - col(l, f"hi{axis}")
        )

    def span(axis: str) -> Column:
        return F.greatest(col(l, f"hi{axis}") - col(r, f"lo{axis}"), col(r, f"hi{axis}") - col(l, f"lo{axis}"))

    return _square(gap("x")) + _square(gap("y")), _square(span("x")) + _square(span("y"))


def _point_segment(px: Column, py: Column, s: Column) -> Column:
    """Square of the distance from a point to a segment, which may have length zero."""
    x0, y0, x1, y1 = (s[n] for n in _LINE)
    dx, dy = x1 - x0, y1 - y0
    along = F.coalesce(F.try_divide((px - x0) * dx + (py - y0) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return _square(px - x0 - t * dx) + _square(py - y0 - t * dy)


def _segment_distance(l: Column, r: Column) -> Column:
    """Square of the distance between two segments."""
    a, b = [l[n] for n in _LINE], [r[n] for n in _LINE]

    def turn(s: list[Column], px: Column, py: Column) -> Column:
        return F.sign((s[2] - s[0]) * (py - s[1]) - (s[3] - s[1]) * (px - s[0]))

    crossing = (turn(a, b[0], b[1]) * turn(a, b[2], b[3]) < 0) & (turn(b, a[0], a[1]) * turn(b, a[2], a[3]) < 0)
    nearest = F.least(
        _point_segment(a[0], a[1], r), _point_segment(a[2], a[3], r),
        _point_segment(b[0], b[1], l), _point_segment(b[2], b[3], l),
    )
    return F.when(crossing, F.lit(0.0)).otherwise(nearest)


def _decided(pairs: DataFrame, eps: float) -> DataFrame:
    """Pairs ``l, r`` of boxes that are not too far apart; ``linked`` when surely near."""
    least, greatest = _box_distances("l", "r")
    return pairs.select("*", least.alias("_least"), (greatest <= eps * eps).alias("linked")).filter(
        F.col("_least") <= eps * eps
    ).drop("_least")


def _neighbours(cells: DataFrame) -> DataFrame:
    """Pairs of cells of a name that can be within eps: each cell with half of those two around it."""
    offsets = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets])
    box = F.struct(*[F.col(c) for c in cells.columns])
    left = cells.select("nk", box.alias("l"), F.explode(steps).alias("d")).select(
        "nk", "l", (F.col("l.cx") + F.col("d.dx")).alias("cx"), (F.col("l.cy") + F.col("d.dy")).alias("cy")
    )
    right = cells.select(*_CELL, box.alias("r"))
    return left.join(right, _CELL).filter(F.col("l.rep") != F.col("r.rep")).select("l", "r")


def _cell_of(side: str) -> list[Column]:
    return [F.col(f"{side}.{c}").alias(c) for c in _CELL]


def _lists_of(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """The segments in each cell of the pairs, as one array; the cells hold ``_TESTS`` pieces at most."""
    cells = pairs.select(*_cell_of("l")).union(pairs.select(*_cell_of("r"))).distinct()
    return pieces.join(cells, _CELL, "left_semi").groupBy(*_CELL).agg(F.collect_list(F.struct(*_LINE)).alias("lines"))


def _compare_few(pairs: DataFrame, pieces: DataFrame, eps: float) -> DataFrame:
    """Links (u, v) of pairs of cells with few pieces, where two segments are within eps."""
    lists = _lists_of(pairs, pieces)
    rows = pairs.select("l", "r", "top")
    for side in "lr":
        own = lists.select(F.struct(*_CELL).alias("cell"), F.col("lines").alias(f"{side}_lines"))
        rows = rows.withColumn("cell", F.struct(*_cell_of(side))).join(own, "cell").drop("cell")
    near = F.exists(
        "l_lines", lambda s: F.exists("r_lines", lambda e: _segment_distance(s, e) <= eps * eps)
    )
    return rows.filter(near).select("top.u", "top.v")


def _compare_many(pairs: DataFrame, pieces: DataFrame, eps: float) -> DataFrame:
    """As ``_compare_few`` for cells that hold many pieces, by a join."""
    rows = pairs.select("pair", "top", *_cell_of("l")).join(pieces, _CELL).select("pair", "top", F.struct(*_LINE).alias("s"))
    others = pairs.select("pair", *_cell_of("r")).join(pieces, _CELL).select("pair", F.struct(*_LINE).alias("e"))
    near = _segment_distance(F.col("s"), F.col("e")) <= eps * eps
    return rows.join(others, "pair").filter(near).select("top.u", "top.v").distinct()


def _near_cells(pairs: DataFrame, eps: float) -> DataFrame:
    """Pairs of boxes that may be near, as a table: ``l, r, linked``, ``pair`` to name them, and the rest."""
    key = F.struct("l.nk", "l.cx", "l.cy", F.col("r.cx").alias("ox"), F.col("r.cy").alias("oy"))
    return durable(_decided(pairs, eps).withColumn("pair", key), "pairs")


def _tests(pairs: DataFrame) -> int:
    """Comparisons it takes to compare all pieces of the pairs."""
    return pairs.agg(F.sum((F.col("l.n") * F.col("r.n")).cast("decimal(38,0)"))).first()[0] or 0


def _open_links(open_pairs: DataFrame, pieces: DataFrame, side: float, eps: float) -> DataFrame:
    """Links (u, v) among the undecided pairs of cells ``l, r, pair, top``, where ``top`` holds u and v.

    Pairs are compared piece by piece when they hold few pieces; crowded ones are cut into smaller cells,
    whose tight boxes are tested the same way. Every pair is thus decided exactly without listing the
    pairs of a crowded cell's pieces.
    """
    links = []
    for depth in range(_MAX_DEPTH + 1):
        few = F.col("l.n") * F.col("r.n") <= _TESTS
        links.append(_compare_few(open_pairs.filter(few), pieces, eps))
        heavy = open_pairs.filter(~few)
        if heavy.isEmpty():
            break
        if depth == _MAX_DEPTH:
            links.append(_compare_many(heavy, pieces, eps))
            break
        side /= _SPLIT
        crowded = heavy.select(*_cell_of("l")).union(heavy.select(*_cell_of("r"))).distinct()
        inner = pieces.join(crowded, _CELL, "left_semi").withColumn("up", F.struct("cx", "cy"))
        pieces = durable(_cut_to_cells(inner, side), "pieces")
        boxes = _boxes(pieces, ["nk", "up", "cx", "cy"])
        box = F.struct(*[F.col(c) for c in (*_CELL, "rep", "n", "lox", "loy", "hix", "hiy")])

        def inside(name: str) -> DataFrame:
            up = F.struct(F.col(f"{name}.cx").alias("cx"), F.col(f"{name}.cy").alias("cy"))
            ups = heavy.select(F.col("pair").alias("outer"), "top", F.col(f"{name}.nk").alias("nk"), up.alias("up"))
            return ups.join(boxes, ["nk", "up"]).select("outer", "top", box.alias(name))

        # at most 64 by 64 cells for a pair
        inner_pairs = _near_cells(inside("l").join(inside("r").drop("top"), "outer"), eps)
        linked = inner_pairs.filter("linked").select("top").distinct()
        links.append(linked.select("top.u", "top.v"))
        rest = inner_pairs.filter("not linked").join(linked, "top", "left_anti")
        open_pairs = rest.select("l", "r", "pair", "top")
        pieces = pieces.drop("up")
    return _all(links)


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def _relabelled(open_pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Undecided pairs whose sides are not yet in one component, with the components as ``top``."""
    rows = open_pairs.select("l", "r", "pair")
    for side, name in (("l", "u"), ("r", "v")):
        own = components.select(F.col("node").alias("_node"), F.col("component").alias(f"_{name}"))
        rows = rows.join(own, F.col(f"{side}.rep") == F.col("_node"), "left").drop("_node")
        rows = rows.withColumn(f"_{name}", F.coalesce(f"_{name}", f"{side}.rep"))
    rows = rows.filter("_u != _v")
    return rows.select("l", "r", "pair", F.struct(F.col("_u").alias("u"), F.col("_v").alias("v")).alias("top"))


def _joined_components(first: DataFrame, links: DataFrame) -> DataFrame:
    """Components after links between components of ``first``, or nodes it lacks, are added."""
    second = durable(connected_components(links), "components")
    new = second.select("node", F.col("node").alias("component")).join(first, "node", "left_anti")
    moved = second.select(F.col("node").alias("component"), F.col("component").alias("_whole"))
    found = first.union(new).join(moved, "component", "left")
    return found.select("node", F.coalesce("_whole", "component").alias("component"))


def _interior_runs(polygons: DataFrame, side: float) -> DataFrame:
    """Blocks of cells inside polygons: ``nk, cy, level, block``, a block being 2^level cells of a row.

    Along the middle of each row of cells, the cells wholly between a way in and a way out.
    """
    lo, hi = F.least("y0", "y1"), F.greatest("y0", "y1")
    first, last = F.ceil(lo / side - 0.5), F.ceil(hi / side - 0.5) - 1
    rows = _mercator_segments(polygons).filter(first <= last)
    rows = rows.select("place_id", "nk", *_LINE, F.explode_outer(F.sequence(first, last)).alias("cy"))
    middle = (F.col("cy") + 0.5) * side
    x_at = F.col("x0") + (middle - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    ways = rows.groupBy("place_id", "nk", "cy").agg(F.array_sort(F.collect_list(x_at)).alias("xs"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size("xs"), 1) - 1),
        lambda i: F.struct(
            (F.floor(F.col("xs")[i * 2] / side) + 1).alias("a"),
            (F.floor(F.col("xs")[i * 2 + 1] / side) - 1).alias("b"),
        ),
    )
    runs = ways.select("place_id", "nk", "cy", F.inline_outer(pairs)).filter("a <= b")

    block_type = "array<struct<level:int,block:bigint>>"

    def blocks_of(a: Column, b: Column) -> Column:
        """A run as blocks, at most two per level: odd ends are split off, then both ends are halved."""
        start = F.struct(a.alias("a"), b.alias("b"), F.array().cast(block_type).alias("out"))

        def step(acc: Column, level: Column) -> Column:
            open_, a, b = acc["a"] <= acc["b"], acc["a"], acc["b"]

            def block(n: Column) -> Column:
                return F.array(F.struct(level.cast("int").alias("level"), n.cast("bigint").alias("block")))

            nothing = F.array().cast(block_type)
            left = open_ & (a.bitwiseAND(1) == 1)
            right = open_ & (b.bitwiseAND(1) == 0) & ~(left & (a == b))
            out = F.concat(
                acc["out"], F.when(left, block(a)).otherwise(nothing), F.when(right, block(b)).otherwise(nothing)
            ).cast(block_type)
            return F.struct(
                # a used-up run stays as it is: halving its ends could make them meet again
                F.when(open_, F.shiftright(F.when(left, a + 1).otherwise(a), 1)).otherwise(a).alias("a"),
                F.when(open_, F.shiftright(F.when(right, b - 1).otherwise(b), 1)).otherwise(b).alias("b"),
                out.alias("out"),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(31)), start, step)["out"]

    return runs.select("place_id", "nk", "cy", F.inline_outer(blocks_of(F.col("a"), F.col("b"))))


def _links_inside(active: DataFrame, cells: DataFrame, side: float) -> list[DataFrame]:
    """Links of polygons that share interior cells, and of cells that lie inside a polygon."""
    polygons = active.filter(F.col("geometry.gtype").isin(*POLYGONAL))
    blocks = durable(_interior_runs(polygons, side), "blocks")
    # at most 32 levels exist, whatever the data
    levels = sorted(r.level for r in blocks.select("level").distinct().collect())
    if not levels:
        return []
    key = ["nk", "cy", "level", "block"]
    owners = blocks.groupBy(*key).agg(F.min("place_id").alias("rep"), F.count("*").alias("n"))
    shared = with_groups(blocks, owners, key, "n", blocks.count(), F.col("place_id")).select(F.col("place_id").alias("u"), F.col("rep").alias("v"))
    # a block may also lie in a longer one of another polygon; cells and blocks look upwards for both
    ups = F.array(*[F.lit(n) for n in levels])
    # only the rows of cells of a name that have a polygon over them can match
    near = cells.join(blocks.select("nk", "cy").distinct(), ["nk", "cy"], "left_semi")
    probes = near.select(
        F.col("rep").alias("u"), "nk", "cy", F.explode(F.transform(ups, lambda n: F.struct(n.alias("level")))).alias("p"), "cx"
    ).select("u", "nk", "cy", "p.level", F.call_function("shiftright", "cx", "p.level").alias("block"))
    higher = owners.select(
        F.col("rep").alias("u"), "nk", "cy", F.col("level").alias("low"), F.col("block").alias("b"),
        F.explode(ups).alias("level"),
    ).filter("level > low").select(
        "u", "nk", "cy", "level", F.call_function("shiftright", "b", F.col("level") - F.col("low")).alias("block")
    )
    looked_up = probes.union(higher).join(owners, key).select("u", F.col("rep").alias("v"))
    return [shared, looked_up]


def _numbered_segments(rows: DataFrame) -> DataFrame:
    """(nk, space, place_id, n, of_polygon, x0, y0, x1, y1), ``n`` counts the segments of an object."""
    x0, y0, x1, y1 = (F.col(f"s.{n}") for n in _LINE)
    flag = F.col("geometry.gtype").isin(*POLYGONAL).alias("of_polygon")
    return rows.select("nk", "space", "place_id", flag, F.posexplode_outer(segments(F.col("geometry"))).alias("n", "s")).select(
        "nk", "space", "place_id", "n", "of_polygon",
        mercator_x(x0).alias("x0"), mercator_y(y0).alias("y0"), mercator_x(x1).alias("x1"), mercator_y(y1).alias("y1"),
    )


def _boxed(objects: DataFrame, eps: float) -> DataFrame:
    """Objects with their number of points and their box, widened by half the distance, read off the geometry once."""
    box = bounds(F.col("geometry"))
    rows = objects.select("place_id", "nk", "geometry", num_points(F.col("geometry")).alias("size"), *[v.alias(k) for k, v in box.items()])
    grow = {"minx": (mercator_x, -eps), "miny": (mercator_y, -eps), "maxx": (mercator_x, eps), "maxy": (mercator_y, eps)}
    sides = [(f(F.col(c)) + by / 2).alias(c) for c, (f, by) in grow.items()]
    return rows.select("place_id", "nk", "geometry", "size", *sides, F.lit(0).cast("long").alias("space"))


def _parted(rows: DataFrame, side: float) -> tuple[DataFrame, DataFrame, bool]:
    """Rows of ``_boxed`` parted anew by squares: (rows with ``space``, ``n`` and ``points`` of it, rows of groups that
    have an object over too many squares, whether a space has more than ``_LEAF`` points).

    A space is named by a square's hash, as a chain of shared squares joins all its objects; spaces that share a hash
    are one space, which parts less but loses no link. The chains are found between squares, not objects, so that they
    cost what the objects cover and not how many they are.
    """
    group = ["nk", "space"]
    at = lambda c: F.floor(F.col(c) / side)
    placed = rows.select("*", at("minx").alias("x0"), at("maxx").alias("x1"), at("miny").alias("y0"), at("maxy").alias("y1"))
    squares = (F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1)
    nowhere = F.when(squares.isNull(), F.col("place_id"))  # without a box an object is alone
    placed = placed.select(*rows.columns, "x0", "x1", "y0", "y1", F.xxhash64(*group, "x0", "y0", nowhere).alias("cell"))
    wide = durable(placed.filter(squares > _MOST_SQUARES).select(*group).distinct(), "wide")
    if wide.isEmpty():
        unparted, parted = placed.limit(0), placed
    else:
        unparted, parted = placed.join(wide, group, "left_semi"), placed.join(wide, group, "left_anti")
    cells = durable(parted.groupBy("cell").agg(F.count("*").alias("m"), F.sum("size").alias("points")), "cells")
    spans = parted.filter(squares > 1).select(*group, "cell", "x0", "x1", "y0", "y1").distinct()
    columns = spans.select(*group, "cell", "y0", "y1", F.explode_outer(F.sequence("x0", "x1")).alias("cx"))
    met = columns.select(*group, "cell", "cx", F.explode_outer(F.sequence("y0", "y1")).alias("cy"))
    joined = connected_components(met.select(F.col("cell").alias("u"), F.xxhash64(*group, "cx", "cy").alias("v")))
    chained = cells.join(joined, F.col("cell") == F.col("node"), "left").select("cell", "m", "points", F.coalesce("component", "cell").alias("to"))
    chained = durable(chained, "chained")
    sums = durable(chained.groupBy("to").agg(F.count("*").alias("k"), F.sum("m").alias("n"), F.sum("points").alias("points")), "space-sizes")
    n_cells, n_rows, most = sums.agg(F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("points"), F.lit(0))).first()
    facts = durable(with_groups(chained.drop("points"), sums, ["to"], "k", n_cells, F.col("cell")).drop("k"), "spaces")
    met = with_groups(parted, facts, ["cell"], "m", n_rows, F.col("place_id")).withColumn("space", F.col("to"))
    return met.select(*rows.columns, "n", "points"), unparted.select(*rows.columns), most > _LEAF


def nearby_components(objects: DataFrame, eps: float = DEFAULT_EPS) -> DataFrame:
    """(node, component) of the objects (``place_id, nk, geometry``) linked to another of the same ``nk``."""
    shared = objects.groupBy("nk").agg(F.count("*").alias("n"), F.sum(num_points(F.col("geometry"))).alias("points")).filter("n > 1")
    shared = durable(shared, "names")
    total, most = shared.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("points"), F.lit(0))).first()
    in_names = with_groups(objects, shared, ["nk"], "n", total, F.col("place_id")).filter("n is not null").drop("n")
    active = durable(in_names, "active")
    small = active.filter(F.col("points") <= _LEAF).select("place_id", "nk", "geometry", F.lit(0).cast("long").alias("space"))
    crowded = []
    if most > _LEAF:
        large = durable(_boxed(active.filter(F.col("points") > _LEAF), eps), "boxed")
        for squares in _SQUARES:
            sized, wide, more = _parted(large, eps * squares)
            fits = F.col("points") <= _LEAF
            small = small.unionByName(sized.filter(fits & (F.col("n") > 1)).select(*small.columns))
            crowded.append(wide)
            large = sized.filter(~fits).drop("n", "points")
            if not more:
                break
        else:
            crowded.append(large)
    pieces = _numbered_segments(small).repartition("nk", "space").sortWithinPartitions("nk", "space")
    found = pieces.mapInArrow(partial(solve_batches, eps=eps), "node long, component long")
    if crowded:
        rest = durable(_all([c.select("place_id", "nk", "geometry") for c in crowded]), "active")
        if not rest.isEmpty():
            found = found.union(_crowded_components(rest, eps))
    return found


def _crowded_components(objects: DataFrame, eps: float) -> DataFrame:
    """As ``nearby_components`` for a written table, with the objects of a name in any number of tasks."""
    side = eps * _SIDE
    lines = _mercator_segments(objects)
    whole = lines.select("*", *[F.col(line).alias(cut) for line, cut in zip(_LINE, _CUT)])
    pieces = durable(_cut_to_cells(whole, side), "pieces")
    cells = durable(_boxes(pieces, _CELL), "cells")
    members = pieces.select(*_CELL, "place_id").distinct()
    in_cell = with_groups(members, cells.select(*_CELL, "rep", "n"), _CELL, "n", pieces.count(), F.col("place_id"))
    stars = in_cell.select(F.col("place_id").alias("u"), F.col("rep").alias("v"))
    pairs = _near_cells(_neighbours(cells), eps)
    linked = pairs.filter("linked").select(F.col("l.rep").alias("u"), F.col("r.rep").alias("v"))
    sure = _all([stars, linked, *_links_inside(objects, cells, side)])
    top = F.struct(F.col("l.rep").alias("u"), F.col("r.rep").alias("v"))
    open_pairs = pairs.filter("not linked").select("l", "r", "pair", top.alias("top"))
    if _tests(open_pairs) <= _TESTS_PER_PIECE * pieces.count():
        return connected_components(sure.union(_open_links(open_pairs, pieces, side, eps)))
    # dense data: most pairs left open lie in one component already, so find the sure components first
    first = durable(connected_components(sure), "components")
    between = durable(_relabelled(open_pairs, first), "pairs")
    return _joined_components(first, _open_links(between, pieces, side, eps))


def with_components(objects: DataFrame, components: DataFrame) -> DataFrame:
    """Adds ``cid``, the component of each object; its own place id when it has no other member."""
    joined = objects.join(components, F.col("place_id") == F.col("node"), "left")
    return joined.withColumn("cid", F.coalesce("component", "place_id")).drop("node", "component")


def cluster_nearby(objects: DataFrame, eps: float = DEFAULT_EPS) -> DataFrame:
    """Adds ``nk``, the name without accents, and ``cid``, the smallest place id of the cluster."""
    named = objects.withColumn("nk", unaccent(F.col("name")))
    return with_components(named, nearby_components(named.select("place_id", "nk", "geometry"), eps))
