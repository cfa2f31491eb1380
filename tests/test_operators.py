"""Operators against brute force on small tables."""

import math
import random
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from placeforge import session
from placeforge.functions import arrays, formats, geometry, text
from placeforge.functions.geometry import Area
from placeforge.operators import cluster, exact, kernels, leaves, lines, ordered
from placeforge.operators.components import connected_components
from placeforge.plans import audit, serve
from placeforge.plans.elems import build_elems
from placeforge.sources import category_tables, labels, snippets, tables
from tests.places import POINT, Place, table


def geometries(spark, *ewkt):
    rows = spark.createDataFrame(list(enumerate(ewkt)), "n int, t string")
    return rows.select("n", formats.from_ewkt(F.col("t")).alias("geometry"))


def values(df, *columns):
    rows = df.select("n", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).orderBy("n").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


G = "geometry"


def test_measures_and_formats(spark):
    ewkt = [
        "SRID=4326;POINT(1 2)",
        "SRID=4326;LINESTRING(0 0,3 4)",
        "SRID=4326;POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 1))",
        "SRID=4326;MULTIPOINT(1 2,3 4)",
        "SRID=4326;MULTILINESTRING((0 0,1 0),(5 5,5 7.5))",
        "SRID=4326;MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((10 10,12 10,12 12,10 10),(11 10.5,11.5 10.5,11.5 10.6,11 10.5)))",
    ]
    g = F.col(G)
    df = geometries(spark, *ewkt)
    assert values(df, formats.to_ewkt(g)) == ewkt
    assert values(df, geometry.num_points(g)) == [1, 2, 9, 2, 4, 12]
    areas = values(df, geometry.area(g))
    assert areas == pytest.approx([0, 0, 15.5, 0, 0, 0.5 + 2 - 0.025])
    assert values(df, geometry.length(g))[1:5:3] == pytest.approx([5, 3.5])
    assert values(df, formats.to_geojson(g))[2] == (
        '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]}'
    )


def test_binary_and_map_input(spark):
    df = spark.createDataFrame(
        [("0101000020E6100000A354675A07DC1B406D4892D6CE66EC3F", r'"a"=>"x, \"y\"", "b"=>NULL, "c=>"=>"\\"')], "h string, m string"
    )
    row = df.select(kernels.from_ewkb_hex(F.col("h")).alias("g"), formats.from_hstore(F.col("m")).alias("m")).first()
    assert row.g.gtype == "POINT" and (row.g.parts[0][0][0].x, row.g.parts[0][0][0].y) == (6.9648718, 0.8875498)
    assert row.m == {"a": 'x, "y"', "b": None, "c=>": "\\"}


def test_validity(spark):
    cases = {
        "POINT(1 1)": True,
        "LINESTRING(0 0,0 0)": False,
        "LINESTRING(0 0,0 0,1 0)": True,
        "POLYGON((0 0,4 4,4 0,0 4,0 0))": False,
        "POLYGON((0 0,4 0,4 4,0 0))": True,
        "POLYGON((0 0,4 0,4 4))": False,
        "POLYGON((0 0,4 0,2 0,0 0))": False,
        "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 1))": True,
        "POLYGON((0 0,4 0,4 4,0 4,0 0),(3 1,6 1,6 2,3 1))": False,
        "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,3 1,3 3,1 1),(2 1.5,2.5 1.5,2.5 1.8,2 1.5))": False,
        "POLYGON((0 0,4 0,4 4,0 4,0 0),(0 0,2 1,1 2,0 0))": True,
        "MULTIPOLYGON(((0 0,4 0,4 4,0 0)),((4 0,8 0,8 4,4 0)))": True,
        "MULTIPOLYGON(((0 0,4 0,4 4,0 0)),((3 1,8 1,8 4,3 1)))": False,
        "POLYGON((0 0,0 0,4 0,4 4,0 0))": True,
    }
    ring = [(math.cos(a), math.sin(a)) for a in (2 * math.pi * k / 500 for k in range(500))]
    large = ",".join(f"{x} {y}" for x, y in [*ring, ring[0]])
    crossed = ",".join(f"{x} {y}" for x, y in [*ring[:100], ring[300], *ring[101:], ring[0]])
    cases |= {f"POLYGON(({large}))": True, f"POLYGON(({crossed}))": False}
    df = geometries(spark, *cases)
    assert values(df, kernels.is_valid(F.col(G))) == list(cases.values())


def test_simplify(spark):
    df = geometries(
        spark, "LINESTRING(0 0,1 0.1,2 0,3 2,4 0)", "POLYGON((0 0,1 0.01,2 0,2 2,0 2,0 0))",
        "POLYGON((0 0,0.1 0,0.1 0.1,0 0.1,0 0))", POINT,
    )
    thin = values(df, formats.to_ewkt(kernels.simplify(F.col(G), 0.5)))
    assert thin[0] == "SRID=4326;LINESTRING(0 0,2 0,3 2,4 0)"
    assert thin[1] == "SRID=4326;POLYGON((0 0,2 0,2 2,0 2,0 0))"
    assert thin[3] == "SRID=4326;POINT(1 1)"
    dropped = values(df, geometry.num_points(kernels.simplify(F.col(G), 0.5, keep_collapsed=False)))
    assert dropped[2] in (None, 0)
    assert values(df, geometry.num_points(kernels.simplify(F.col(G), 0.5)))[2] == 4
    assert max(values(df, geometry.num_points(kernels.simplify_to(F.col(G), 4)))) <= 4


def inside(ring, x, y):
    found = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (y0 > y) != (y1 > y) and x < x0 + (y - y0) / (y1 - y0) * (x1 - x0):
            found = not found
    return found


@pytest.mark.parametrize("shell, holes", [
    ([(0, 0), (10, 1), (9, 9), (2, 8)], []),
    ([(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)], []),
    ([(0, 0), (0, 10), (10, 10), (10, 0)], [[(3, 3), (7, 3), (7, 7), (3, 7)]]),
])
def test_overlap_against_sampling(spark, shell, holes):
    rng = random.Random(7)
    boxes = [(rng.uniform(-2, 9), rng.uniform(-2, 9), rng.uniform(0.5, 4), rng.uniform(0.5, 4)) for _ in range(12)]
    df = geometries(
        spark,
        *[f"POLYGON(({x} {y},{x + w} {y},{x + w} {y + h},{x} {y + h},{x} {y}))" for x, y, w, h in boxes],
        "LINESTRING(-1 5,11 5)", "POINT(5 5)", "POINT(0 0)", "LINESTRING(-5 -5,-1 -1)",
        "POLYGON((-20 -20,20 -20,20 20,-20 20,-20 -20))",
    )
    area = Area(shell, holes)
    found = values(df, geometry.intersection_area(F.col(G), area), geometry.intersects(F.col(G), area))

    def within(x, y):
        return inside(shell, x, y) and not any(inside(h, x, y) for h in holes)

    steps = 60
    for (x, y, w, h), (overlap, touches) in zip(boxes, found):
        hits = sum(
            within(x + (i + 0.5) * w / steps, y + (j + 0.5) * h / steps) for i in range(steps) for j in range(steps)
        )
        assert overlap == pytest.approx(hits / steps**2 * w * h, abs=0.03 * w * h)
        if hits:
            assert touches
    assert found[12][1] and found[14][1] and not found[15][1] and found[16][1]
    assert found[13][1] == (not holes and within(5, 5))


def test_query_area(spark):
    places = [
        Place("in", 1, 1, shape="POINT(1 1)"), Place("out", 2, 2, shape="POINT(9 9)"),
        Place("most", 3, 3, shape="POLYGON((3 0,5 0,5 1,3 1,3 0))"),
        Place("little", 4, 4, shape="POLYGON((3.8 2,7 2,7 3,3.8 3,3.8 2))"),
        Place("line", 5, 5, shape="LINESTRING(4 4,9 9)"), Place("edge", 6, 6, shape="POINT(0 2)"),
    ]
    built = build_elems(table(spark, places))
    square = Area([(0, 0), (4, 0), (4, 4), (0, 4)])
    assert [r.name for r in serve.query_area(built, square).collect()] == ["in", "most", "line", "edge"]
    assert [r.name for r in serve.query_area(built, square, after=1, count=2).collect()] == ["most", "line"]
    line = built.filter("popindex = 1").select(serve.listing_line().alias("t")).first().t
    assert line == "1. in. c. place. N1"


def test_write_and_check(spark, tmp_path):
    built = build_elems(table(spark, [Place(str(n), n + 1, n, shape=f"POINT({n} {n})") for n in range(9)]))
    tables.check_elems(built)
    for by in ("area", "popindex"):
        tables.write_elems(built, str(tmp_path / by), by)
        read = spark.read.parquet(str(tmp_path / by))
        assert sorted(r.popindex for r in read.collect()) == list(range(1, 10))
    with pytest.raises(ValueError, match="1..n"):
        tables.check_elems(built.withColumn("popindex", F.col("popindex") * 2))
    # ranks with the sum and the sum of squares of 1 to 8
    same_sums = F.element_at(F.array(*map(F.lit, [1, 3, 3, 4, 4, 5, 8, 8, 9])), F.col("popindex").cast("int"))
    with pytest.raises(ValueError, match="1..n"):
        tables.check_elems(built.withColumn("popindex", same_sums.cast("long")))
    with pytest.raises(ValueError, match="empty"):
        tables.check_elems(built.withColumn("name", F.lit(None).cast("string")))


def test_category_files(spark, tmp_path):
    keys, overrides = tmp_path / "keys", tmp_path / "overrides"
    keys.write_text("// header\n" + "\n".join(" ".join(k) for k in category_tables.KEYS) + "\n")
    overrides.write_text("// header\n" + "\n".join(" ".join(o) for o in category_tables.OVERRIDES) + "\n")
    assert category_tables.load_key_table(spark, str(keys)).collect() == category_tables.key_table(spark).collect()
    loaded = category_tables.load_override_table(spark, str(overrides)).collect()
    assert loaded == category_tables.override_table(spark).collect()
    keys.write_text("// header\naerialway c x y\n")
    with pytest.raises(Exception, match="bad key table line"):
        category_tables.load_key_table(spark, str(keys)).collect()
    overrides.write_text("// header\nplace city c\n")
    with pytest.raises(Exception, match="bad override table line"):
        category_tables.load_override_table(spark, str(overrides)).collect()


def test_labels_and_snippets(spark, tmp_path):
    path = tmp_path / "labels"
    path.write_text(
        "amenity atm 'Atm'\nboundary administrative:1 'Continent'\nplace hamlet 'Hamlet'\nbuilding yes 'Building'\n"
    )
    assert [tuple(r) for r in labels.load_labels(spark, str(path)).collect()][0] == ("amenity", "atm", "Atm")
    odd = labels.odd_labels(spark.read.text(str(path))).collect()
    assert [r.value for r in odd] == ["boundary administrative:1 'Continent'", "building yes 'Building'"]
    source = tmp_path / "source"
    source.write_text(
        'strcmp(k, "no")\n***START***\n if (strcmp(k, "shop") == 0 ||\n strcmp(k, "club") == 0\n***STOP***\nstrcmp(k, "x")\n'
    )
    texts = spark.read.text(str(source), wholetext=True)
    found = snippets.interesting_keys(snippets.between_markers(texts)).collect()
    assert [r.key for r in found] == ["building", "club", "shop"]


def test_text_functions(spark):
    df = spark.createDataFrame(
        [
            (0, "São Tomé", "pt:sao_tome_e"), (1, "Straße Œuvre Łódź", "x"), (2, "100% Gulch", "en:100_m_Gulch"),
            (3, "a\\b", "en:ab"), (4, "Obo", "en:Other"), (5, "under_score", "en:Under score"),
        ],
        "n int, name string, wiki string",
    )
    tested = values(df, text.test_wikipedia(F.col("name"), F.col("wiki")))
    assert tested == ["pt:sao_tome_e", None, "en:100_m_Gulch", "en:ab", None, "en:Under score"]
    assert values(df, text.unaccent(F.col("name")))[1] == "Strasse OEuvre Lodz"
    sample = spark.createDataFrame(
        [([1, 2, 3, 4, 5, 6, 7, 8, 9, 1], ["1", "2", "3", "1", "3", "4", "1", "2", "2", "432"])], "v array<int>, i array<string>"
    )
    assert sample.select(arrays.with_unique_id(F.col("v"), F.col("i"))).first()[0] == [1, 2, 3, 6, 1]


def test_positions_and_pages_of_a_large_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("k"), F.xxhash64("id").alias("v"), "id")
    placed = ordered.position_in_group(rows, ["k"], [F.col("v")]).collect()
    for key in ("hot", "cold"):
        own = sorted((r for r in placed if r.k == key), key=lambda r: r.v)
        assert [r.pos for r in own] == list(range(1, len(own) + 1))
    pages = ordered.list_pages(rows, ["k"], [F.col("v")], ["id"], 1500).collect()
    assert sorted((r.k, r.page, len(r["items"])) for r in pages) == [
        ("cold", 0, 1000), ("hot", 0, 1500), ("hot", 1, 1500), ("hot", 2, 1000),
    ]
    joined = [i.id for p in sorted((p for p in pages if p.k == "hot"), key=lambda p: p.page) for i in p["items"]]
    assert joined == [r.id for r in sorted((r for r in placed if r.k == "hot"), key=lambda r: r.v)]
    ranked = ordered.position_in_table(rows, [F.col("v")], "nth").collect()
    assert [r.nth for r in sorted(ranked, key=lambda r: r.v)] == list(range(1, 5001))


def components_of(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(180)]
    order = list(range(2400))
    rng.shuffle(order)
    edges = [(order[u], order[v]) for u, v in edges]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = components_of({n for e in edges for n in e if e[0] != e[1]}, edges)
    assert found == expected


def segment_distance(a, b):
    def point(p, s):
        (x0, y0), (x1, y1) = s
        dx, dy = x1 - x0, y1 - y0
        n = dx * dx + dy * dy
        t = 0 if n == 0 else max(0, min(1, ((p[0] - x0) * dx + (p[1] - y0) * dy) / n))
        return math.hypot(p[0] - x0 - t * dx, p[1] - y0 - t * dy)

    def turn(s, p):
        return (s[1][0] - s[0][0]) * (p[1] - s[0][1]) - (s[1][1] - s[0][1]) * (p[0] - s[0][0])

    if turn(a, b[0]) * turn(a, b[1]) < 0 and turn(b, a[0]) * turn(b, a[1]) < 0:
        return 0.0
    return min(point(a[0], b), point(a[1], b), point(b[0], a), point(b[1], a))


def mercator(x, y):
    r = 6378137.0
    return r * math.radians(x), r * math.log(math.tan(math.pi / 4 + math.radians(y) / 2))


def brute_force_clusters(shapes, eps):
    """shapes: id -> (is polygon, list of points in degrees)"""
    flat = {}
    for key, (closed, pts) in shapes.items():
        m = [mercator(*p) for p in pts]
        flat[key] = (closed, m, list(zip(m, m[1:])) or [(m[0], m[0])])
    edges = []
    keys = sorted(flat)
    for n, u in enumerate(keys):
        for v in keys[:n]:
            (cu, pu, su), (cv, pv, sv) = flat[u], flat[v]
            near = min(segment_distance(a, b) for a in su for b in sv) <= eps
            near = near or (cu and inside(pu[:-1], *pv[0])) or (cv and inside(pv[:-1], *pu[0]))
            if near:
                edges.append((u, v))
    return components_of(keys, edges)


def _clustered(spark, shapes, eps):
    rows = []
    for key, (closed, pts) in shapes.items():
        body = ",".join(f"{x!r} {y!r}" for x, y in pts)
        kind = "POLYGON" if closed else ("POINT" if len(pts) == 1 else "LINESTRING")
        rows.append((key, "x", f"{kind}(({body}))" if closed else f"{kind}({body})"))
    df = spark.createDataFrame(rows, "place_id long, name string, t string")
    df = df.select("place_id", "name", formats.from_ewkt(F.col("t")).alias("geometry"))
    return {r.place_id: r.cid for r in cluster.cluster_nearby(df, eps).collect()}


@pytest.mark.parametrize("seed, per_piece, leaf", [(1, 32, 0), (2, 0, 0), (1, 32, 20_000), (2, 32, 20_000), (3, 32, 60)])
def test_clusters_of_mixed_shapes(spark, monkeypatch, seed, per_piece, leaf):
    monkeypatch.setattr(cluster, "_TESTS_PER_PIECE", per_piece)
    monkeypatch.setattr(cluster, "_LEAF", leaf)
    rng = random.Random(seed)
    shapes = {}
    for key in range(110):
        x, y = rng.uniform(-0.02, 0.02), rng.uniform(-0.02, 0.02)
        kind = key % 4
        if kind == 0:
            shapes[key] = (False, [(x, y)])
        elif kind == 1:
            shapes[key] = (False, [(x, y)] + [(x + rng.uniform(-1, 1) * 2e-3, y + rng.uniform(-1, 1) * 2e-3) for _ in range(2)])
        elif kind == 2:
            r = rng.choice([2e-4, 1e-3, 4e-3])
            ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a in (0.3, 2.0, 3.5, 5.0)]
            shapes[key] = (True, [*ring, ring[0]])
        else:
            shapes[key] = (False, [(x, y)])
    assert _clustered(spark, shapes, 100.0) == brute_force_clusters(shapes, 100.0)


@pytest.mark.parametrize("batch, leaf", [(7, 20_000), (100_000, 20_000), (40, 9)])
def test_clusters_of_many_names(spark, monkeypatch, batch, leaf):
    """Names next to each other never mix; leaves may end anywhere in a batch; far names and lone objects."""
    monkeypatch.setattr(leaves, "BATCH", batch)
    monkeypatch.setattr(cluster, "_LEAF", leaf)
    rng = random.Random(8)
    shapes, names = {}, {}
    for key in range(160):
        x, y = rng.choice([0, 0, 0, 170]) + rng.uniform(-0.01, 0.01), rng.choice([0, 0, -80]) + rng.uniform(-0.004, 0.004)
        pts = [(x, y)] if key % 3 else [(x, y), (x + rng.uniform(-1, 1) * 1e-3, y)]
        shapes[key], names[key] = (False, pts), rng.choice("aabbbcddddddé") if key else "lone"
    expected = {}
    for name in set(names.values()):
        expected |= brute_force_clusters({k: s for k, s in shapes.items() if names[k] == name}, 100.0)
    body = lambda pts: ",".join(f"{x!r} {y!r}" for x, y in pts)
    rows = [(k, names[k], f"{'LINESTRING' if len(s[1]) > 1 else 'POINT'}({body(s[1])})") for k, s in shapes.items()]
    df = spark.createDataFrame(rows, "place_id long, name string, t string").select("place_id", "name", formats.from_ewkt(F.col("t")).alias("geometry"))
    want = {k: (v if names[k] != "é" else None) for k, v in expected.items()}
    found = {r.place_id: r.cid for r in cluster.cluster_nearby(df, 100.0).collect()}
    assert {k: v for k, v in found.items() if want[k] is not None} == {k: v for k, v in want.items() if v is not None}


def test_spots_in_a_row_are_parted_by_smaller_squares(spark, monkeypatch):
    """Spots 1.5 km apart are one chain of wide squares; small squares part them, so nothing is spread by cells."""

    def spread(*_):
        raise AssertionError("spread by cells")

    monkeypatch.setattr(cluster, "_LEAF", 12)
    monkeypatch.setattr(cluster, "_crowded_components", spread)
    rng = random.Random(4)
    shapes = {}
    for key in range(90):
        x, y = 0.0135 * (key % 15) + rng.uniform(0, 4e-4), rng.uniform(0, 4e-4)
        shapes[key] = (False, [(x, y)] if key % 2 else [(x, y), (x + 3e-4, y)])
    assert _clustered(spark, shapes, 100.0) == brute_force_clusters(shapes, 100.0)


@pytest.mark.parametrize("gap, clusters, leaf", [(99.5, 1, 0), (100.5, 2, 0), (99.5, 1, 20_000), (100.5, 2, 20_000)])
def test_crowded_neighbour_cells(spark, monkeypatch, gap, clusters, leaf):
    """Two crowds just under or over the distance apart: decided by smaller and smaller cells."""
    monkeypatch.setattr(cluster, "_TESTS", 16)
    monkeypatch.setattr(cluster, "_LEAF", leaf)
    monkeypatch.setattr(leaves, "_AT_ONCE", 1000)
    rng = random.Random(5)
    per_degree = 6378137 * math.pi / 180
    shapes = {}
    for key in range(300):
        side, depth = key % 2, rng.uniform(0, 30)
        x = 10 - depth if side == 0 else 10 + gap + depth
        shapes[key] = (False, [(x / per_degree, rng.uniform(10, 12) / per_degree)])
    shapes[1000] = (False, [(10 / per_degree, 11 / per_degree)])
    shapes[1001] = (False, [((10 + gap) / per_degree, 11 / per_degree)])
    found = _clustered(spark, shapes, 100.0)
    assert found == brute_force_clusters(shapes, 100.0)
    assert len(set(found.values())) == clusters


def test_union_of_lines(spark, monkeypatch):
    """A crowded star of lines and crossing lines, cut at all their meetings."""
    monkeypatch.setattr(lines, "_CROWDED", 8)
    shapes = [f"LINESTRING(-10 {k + 0.5},10 {k + 0.5})" for k in range(6)]
    shapes += [f"LINESTRING({k} -5,{k} 15)" for k in range(-4, 4)]
    shapes += ["LINESTRING(20 0,21 0,22 0,23 1)", "LINESTRING(22 0,21 0,21 5)", "LINESTRING(30 0,31 1,30 1,31 0)"]
    df = geometries(spark, *shapes).select(F.lit(7).alias("grp"), F.col("n").alias("line"), G)
    (row,) = lines.union_lines(df).collect()
    ways = {tuple((p.x, p.y) for p in part[0]) for part in row.geometry.parts}
    grid = 6 * 9 + 8 * 7
    # the bent line is cut where the other runs along it; the last one crosses itself
    assert {((20, 0), (21, 0)), ((21, 0), (22, 0)), ((22, 0), (23, 1)), ((21, 0), (21, 5))} <= ways
    looped = [w for w in ways if min(x for x, _ in w) >= 30]
    assert len(looped) == 3 and (30.5, 0.5) in {p for w in looped for p in w}
    assert len(ways) == grid + 4 + 3


def test_union_of_a_star(spark, monkeypatch):
    """Very many lines from one end, some along each other, and lines across them."""
    monkeypatch.setattr(lines, "_CROWDED", 6)
    monkeypatch.setattr(lines, "_MAX_DEPTH", 2)
    rays = [(math.cos(0.1 + k * 0.05), math.sin(0.1 + k * 0.05)) for k in range(25)]
    shapes = [f"LINESTRING(0 0,{x!r} {y!r})" for x, y in rays]
    shapes += ["LINESTRING(0 0,-1 -1)", "LINESTRING(0 0,-2 -2)", "LINESTRING(-1 0,1 0)", "LINESTRING(-3 -2.5,2 -2.5)"]
    df = geometries(spark, *shapes).select(F.lit(7).alias("grp"), F.col("n").alias("line"), G)
    (row,) = lines.union_lines(df).collect()
    ways = {tuple((p.x, p.y) for p in part[0]) for part in row.geometry.parts}
    assert len(ways) == 25 + 2 + 2 + 1
    assert {((-2, -2), (-1, -1)), ((-1, -1), (0, 0)), ((-1, 0), (0, 0)), ((0, 0), (1, 0))} <= ways


def _ways(spark, *shapes):
    df = geometries(spark, *shapes).select(F.lit(7).alias("grp"), F.col("n").alias("line"), G)
    found = lines.union_lines(df).collect()
    return sorted(tuple((p.x, p.y) for p in part[0]) for row in found for part in row.geometry.parts)


def test_union_of_slanted_junctions(spark):
    """Ends that rounding puts beside a slanted line cut it all the same, and leave no hair-thin ways."""
    assert _ways(spark, "LINESTRING(6.1 0.2,6.7 0.5)", "LINESTRING(6.4 0.35,6.3 0.9)") == [
        ((6.1, 0.2), (6.4, 0.35)), ((6.3, 0.9), (6.4, 0.35)), ((6.4, 0.35), (6.7, 0.5)),
    ]
    # along each other: the shorter one is a part of the longer one
    assert _ways(spark, "LINESTRING(6.1 0.2,6.7 0.5)", "LINESTRING(6.3 0.3,6.5 0.4)") == [
        ((6.1, 0.2), (6.3, 0.3)), ((6.3, 0.3), (6.5, 0.4)), ((6.5, 0.4), (6.7, 0.5)),
    ]
    # an end a hair from another line's end is the same place
    assert _ways(spark, "LINESTRING(0 0,1 1)", f"LINESTRING({1 + 2e-16!r} {1 - 1e-16!r},2 5)") == [((0, 0), (1, 1)), ((1, 1), (2, 5))]
    # farther off than a pixel it is another one
    assert len(_ways(spark, "LINESTRING(0 0,2 2)", "LINESTRING(1.000000001 1,2 0)")) == 2


def test_union_of_lines_through_one_computed_point(spark):
    cx, cy, turns = 6.123456789, 0.987654321, [0.3, 0.9, 1.7, 2.2, 2.9]
    ends = [((cx - math.cos(a), cy - math.sin(a)), (cx + 2 * math.cos(a), cy + 2 * math.sin(a))) for a in turns]
    ways = _ways(spark, *[f"LINESTRING({a[0]!r} {a[1]!r},{b[0]!r} {b[1]!r})" for a, b in ends])
    outer = {p for e in ends for p in e}
    inner = {p for w in ways for p in w if p not in outer}
    assert len(ways) == 2 * len(turns) and len(inner) == 1
    (x, y) = inner.pop()
    assert abs(x - cx) < 1e-12 and abs(y - cy) < 1e-12
    # a line that ends there gives the point
    ways = _ways(spark, *[f"LINESTRING({a[0]!r} {a[1]!r},{b[0]!r} {b[1]!r})" for a, b in ends], f"LINESTRING({cx!r} {cy!r},9 9)")
    assert len(ways) == 2 * len(turns) + 1 and all((cx, cy) in w for w in ways)


def test_union_with_hot_places_and_long_lines(spark, monkeypatch):
    """Spread plans give what the plain ones give."""
    monkeypatch.setattr(lines, "_LONG_LINE", 10)
    shapes = ["LINESTRING(0 0,60 0)"] + [f"LINESTRING({k} {-1 - k % 3},{k} 1)" for k in range(1, 40)] + ["LINESTRING(50 5,50 0)"] * 3
    ways = _ways(spark, *shapes)
    assert len(ways) == 39 * 2 + 41 + 1
    assert ((50, 0), (50, 5)) in ways and ((40, 0), (50, 0)) not in ways and ((39, 0), (50, 0)) in ways


def test_turns_have_their_exact_sign():
    rng = random.Random(4)
    rows = []
    for _ in range(4000):
        a, b = [rng.uniform(-1, 1) for _ in range(2)], [rng.uniform(-1, 1) for _ in range(2)]
        u = rng.random()
        p = [a[i] + u * (b[i] - a[i]) + rng.choice([0, 0, 1e-17, -3e-17, 2e-16, 0.1]) for i in range(2)]
        rows.append((*a, *b, *p))
    rows += [(0.0, 0.0, 3.0, 3.0, 1.0, 1.0), (0.1, 0.1, 0.3, 0.3, 0.2, 0.2), (1e-300, 0.0, 1.0, 1e-200, 0.5, 0.0)]
    found = exact.turn(*np.array(rows).T)
    for row, value in zip(rows, found):
        ax, ay, bx, by, px, py = map(Fraction, row)
        true = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        assert (value > 0) == (true > 0) and (value < 0) == (true < 0), row
    plain = [(r[2] - r[0]) * (r[5] - r[1]) - (r[3] - r[1]) * (r[4] - r[0]) for r in rows]
    assert any((p > 0) != (v > 0) or (p < 0) != (v < 0) for p, v in zip(plain, found))  # where rounding is wrong


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_union_of_random_lines(spark, monkeypatch, seed):
    """Number of ways against all pairs of segments, for lines in general position."""
    monkeypatch.setattr(lines, "_CROWDED", 5)
    rng = random.Random(seed)
    drawn = [[(rng.random(), rng.random()) for _ in range(3)] for _ in range(18)]
    df = geometries(spark, *["LINESTRING(" + ",".join(f"{x!r} {y!r}" for x, y in line) + ")" for line in drawn])
    (row,) = lines.union_lines(df.select(F.lit(1).alias("grp"), F.col("n").alias("line"), G)).collect()
    flat = [(n, i, s) for n, line in enumerate(drawn) for i, s in enumerate(zip(line, line[1:]))]
    crossings = sum(
        segment_distance(s, e) == 0.0
        for k, (n, i, s) in enumerate(flat) for m, j, e in flat[:k] if not (n == m and abs(i - j) == 1)
    )
    # each crossing adds a way to both lines
    assert len(row.geometry.parts) == len(drawn) + 2 * crossings


def test_details_and_reference_systems(spark):
    df = table(spark, [Place("a", 1), Place("b", 2), Place("b", 3, osm_type="W")], first_id=7)
    assert sorted(r.place_id for r in audit.place_details(df, "b").collect()) == [8, 9]
    assert [r.name for r in audit.place_details(df, "", [7]).collect()] == ["a"]
    assert audit.rows_of_object(df, "W", 3).first().web.endswith("/way/3")
    systems = spark.createDataFrame([(3857, 'UNIT["metre",1]'), (4326, 'UNIT["degree",0.01]')], "srid int, srtext string")
    assert [r.srid for r in audit.reference_systems(systems, r'UNIT\["metre"').collect()] == [3857]


def test_work_tables(spark, monkeypatch):
    folder = Path(session.work_dir(spark)) / spark.sparkContext.applicationId
    assert session.durable(spark.range(5), "x").count() == 5 and any(folder.iterdir())
    session.clear_work(spark)
    assert not folder.exists()
    # without the setting, a local session gets a folder of its own, always the same
    monkeypatch.setattr(session, "CHECKPOINT_SETTING", "spark.no.such.setting")
    own = session.work_dir(spark)
    assert own == session.work_dir(spark) and Path(own).is_dir()


def test_union_of_many_ways_goes_on_in_pages(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lines, "PAGE_POINTS", 10)
    places = [Place("road", n + 1, n, key="highway", shape=f"LINESTRING({n} 0,{n + 1} 0)") for n in range(12)]
    built = build_elems(table(spark, [*places, Place("dot", 99, 29, shape="POINT(50 50)")]))
    tables.write_elems(built, str(tmp_path / "elems"))
    built = spark.read.parquet(str(tmp_path / "elems"))
    tables.check_elems(built)
    road = built.filter("name = 'road'").orderBy("page").collect()
    assert [(r.page, len(r.geometry.parts), r.geometry.gtype) for r in road] == [(0, 5, "MULTILINESTRING"), (1, 5, "MULTILINESTRING"), (2, 2, "MULTILINESTRING")]
    assert len({r.popindex for r in road}) == 1
    ends = {part[0][0].x for r in road for part in r.geometry.parts}
    assert ends == set(map(float, range(12)))
    for x, y, names in ((0.5, 0, ["road"] * 3), (6.5, 0, ["road"] * 3), (11.5, 0, ["road"] * 3), (30, 0, []), (50, 50, ["dot"])):
        spot = Area([(x - 0.1, y - 0.1), (x + 0.1, y - 0.1), (x + 0.1, y + 0.1), (x - 0.1, y + 0.1)])
        assert [r.name for r in serve.query_area(built, spot).collect()] == names
