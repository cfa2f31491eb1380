"""Lists on every row, early stop of area queries, connected insides and thinning to a number of points."""

import random

import pytest
from pyspark.sql import functions as F

from placeforge.functions import formats, geometry
from placeforge.functions.geometry import Area
from placeforge.operators import kernels, ordered
from placeforge.plans import serve
from placeforge.sources import tables


@pytest.mark.parametrize("page", [4, 1000])
def test_running_lists_by_reference(spark, page):
    """A hot group and others: lists put together from pages are those of the definition."""
    rng = random.Random(1)
    rows = [(rng.choice("aaaaab") if i % 9 else None, i, f"v{i}" if i % 5 else None) for i in range(120)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, v string")
    listed, pages = ordered.running_lists(df, ["k"], [F.col("i")], ["v"], page)
    by_page = {(r["k"], r["page"]): [x["v"] for x in r["items"]] for r in pages.collect()}
    assert sum(map(len, by_page.values())) == len(rows) and max(map(len, by_page.values())) <= page
    own = {r["i"]: r for r in ordered.lists_on_rows(listed, pages, ["k"]).collect()}
    assert len(own) == len(rows)
    for k in "ab", None:
        for k in k or [None]:
            whole = sorted((i, v) for g, i, v in rows if g == k)
            for pos, (i, _) in enumerate(whole):
                r = own[i]
                before = [v for p in range(r["page"]) for v in by_page[k, p]] + [x["v"] for x in r["items"]][: r["length"]]
                assert before == [v for _, v in whole[: pos + 1]] and r["pos"] == pos + 1
            assert [v for p in range(-(-len(whole) // page)) for v in by_page[k, p]] == [v for _, v in whole]


def _stored(spark, path, rows, files):
    df = spark.createDataFrame(rows, "popindex long, page long, name string, t string, osm_ids string")
    g = formats.from_ewkt(F.col("t"))
    df = df.select("popindex", "page", "name", F.lit("c").alias("supercat"), F.lit("x").alias("subcat"), g.alias("geometry"), F.lit(0.0).alias("area"), "osm_ids")
    df = df.select("*", *[v.alias(k) for k, v in geometry.bounds(F.col("geometry")).items()])
    spark.conf.set("spark.sql.shuffle.partitions", str(files))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.write_elems(df, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return df


def test_area_query_stops_early(spark, tmp_path):
    rng = random.Random(2)
    # near the equator ranks are small, so files there hold the answer
    rows = []
    for i in range(1, 401):
        x, y = (rng.uniform(0, 10), rng.uniform(0, 1)) if i <= 100 else (rng.uniform(0, 60), rng.uniform(2, 60))
        rows.append((i, 0, f"n{i}", f"POINT({x} {y})", f"N{i}"))
    df = _stored(spark, str(tmp_path / "e"), rows, 40)
    around = Area([(-1, -1), (61, -1), (61, 61), (-1, 61)])
    part = Area([(2, 0.5), (30, 0.5), (30, 30), (2, 30)])
    written = spark.read.parquet(str(tmp_path / "e" / tables.MANIFEST)).count()
    assert written >= 30
    for area, after, count in ((around, 0, 5), (around, 90, 20), (part, 3, 10), (part, 150, 7), (part, 390, 50), (Area([(-9, -9), (-8, -9), (-8, -8)]), 0, 5)):
        want = [tuple(r) for r in serve.query_area(df, area, after, count).select("popindex", "name", "osm_ids").collect()]
        got = [tuple(r) for r in serve.query_stored(spark, str(tmp_path / "e"), area, after, count).select("popindex", "name", "osm_ids").collect()]
        assert got == want
        ranks, read = serve.find_ranks(spark, str(tmp_path / "e"), area, after, count, files_at_once=2)
        assert ranks == [r[0] for r in want] and len(read) == len(set(read))
    ranks, read = serve.find_ranks(spark, str(tmp_path / "e"), around, 0, 5, files_at_once=2)
    assert len(read) < written / 3
    assert serve.find_ranks(spark, str(tmp_path / "e"), Area([(-9, -9), (-8, -9), (-8, -8)]))[1] == []


def test_area_query_finds_all_pages(spark, tmp_path):
    rows = [(i, 0, f"n{i}", f"POINT({i} 1)", f"N{i}") for i in range(1, 30)]
    rows += [(7, 1, "n7", "POINT(50 50)", "N700"), (7, 2, "n7", "POINT(-50 -50)", "N701")]  # pages far from the area
    _stored(spark, str(tmp_path / "e"), rows, 12)
    found = serve.query_stored(spark, str(tmp_path / "e"), Area([(6.5, 0), (9.5, 0), (9.5, 2), (6.5, 2)]), 0, 2).collect()
    assert [(r.popindex, r.page) for r in found] == [(7, 0), (7, 1), (7, 2), (8, 0)]


def _valid(spark, *ewkt):
    df = spark.createDataFrame(list(enumerate(ewkt)), "n int, t string").select("n", formats.from_ewkt(F.col("t")).alias("geometry"))
    df = spark.createDataFrame(df.collect(), df.schema)
    return [r[0] for r in df.orderBy("n").select(kernels.is_valid(F.col("geometry"))).collect()]


def test_connected_inside(spark):
    shell = "(0 0,20 0,20 20,0 20,0 0)"
    hook = "(1 1,3 1,3 1.5,1.5 1.5,1.5 2.5,3 2.5,3 3,1 3,1 1)"
    assert _valid(
        spark,
        f"POLYGON({shell},{hook},(3 1.5,3.5 2,3 2.5,3.25 2,3 1.5))",  # two touches close off a part
        f"POLYGON({shell},{hook},(3 1.5,3.5 1.5,3.5 2,3 1.5))",  # one touch
        f"POLYGON({shell},(0 5,5 6,5 4,0 5))",  # a hole at the shell once
        f"POLYGON({shell},(0 5,20 6,10 2,0 5))",  # from side to side
        f"POLYGON({shell},(2 2,6 2,4 6,2 2),(6 2,10 2,8 6,6 2),(4 6,8 6,6 10,4 6))",  # three in a ring
        f"POLYGON({shell},(2 2,6 2,4 6,2 2),(6 2,10 2,8 6,6 2),(10 2,14 2,12 6,10 2))",  # three in a row
        f"POLYGON({shell},(2 2,6 2,4 6,2 2),(6 2,10 2,8 6,6 2),(6 2,8 0.5,4 0.5,6 2))",  # three at one point
        f"POLYGON({shell},(2 2,6 2,4 6,2 2),(4 2,5 0.5,3 0.5,4 2))",  # a corner on an edge
    ) == [False, True, True, False, False, True, True, True]


def test_thinning_to_a_number_of_points(spark):
    rng = random.Random(3)
    shapes = []
    for _ in range(30):
        lines = [[(i, rng.uniform(0, 1) * rng.choice([0.01, 1, 5000])) for i in range(rng.randint(2, 40))] for _ in range(rng.randint(1, 4))]
        shapes.append("MULTILINESTRING(" + ",".join("(" + ",".join(f"{x} {y!r}" for x, y in line) + ")" for line in lines) + ")")
    shapes.append("POLYGON((0 0,1 0.001,2 0,3 0.5,3 3,0 3,0 0),(1 1,1.5 0.99,2 1,2 2,1 2,1 1))")
    df = spark.createDataFrame(list(enumerate(shapes)), "n int, t string").select("n", formats.from_ewkt(F.col("t")).alias("geometry"))
    df = spark.createDataFrame(df.collect(), df.schema)
    for most in (8, 11, 20):
        small = kernels.simplify_to(F.col("geometry"), most)
        found = df.select("n", "geometry", small.alias("small")).collect()
        for r in found:
            size = sum(len(ring) for part in r.small.parts for ring in part)
            assert size <= most
            if r.geometry.gtype == "POLYGON":
                assert all(ring[0] == ring[-1] and len(ring) >= 4 for part in r.small.parts for ring in part)
            else:  # the best tolerance: one point more would be too many
                weights = sorted(w for part in kernels.decode_geometries(_arrow(r.geometry)) for rings in part[1] for w in kernels._weights(rings[0]))
                kept = sum(w == float("inf") for w in weights)
                room = most - kept
                free = sorted((w for w in weights if w not in (float("inf"), 0.0)), reverse=True)
                assert size == kept + (len(free) if len(free) <= room else sum(w > free[room] for w in free))


def _arrow(g):
    import numpy as np

    return kernels.encode_geometries([(g.gtype, [[np.array([tuple(p) for p in ring]) for ring in part] for part in g.parts])])
