"""The golden cases: small tables of places and the objects they must give."""

import math
from collections import Counter

import pytest

from checks import queries
from placeforge.operators import rank
from placeforge.plans.elems import build_elems
from tests.places import LINE, POINT, SQUARE, Place, coordinates, elems, parts, table

PER_DEGREE = {0: 111319.458, 30: 96486.24755677342, 60: 55799.979, 85: 9734.518271497967}


def line(*xy):
    return "LINESTRING(" + ",".join(f"{x} {y}" for x, y in xy) + ")"


def test_empty(spark):
    assert elems(spark, []) == []


def test_single(spark):
    (row,) = elems(
        spark,
        [Place("Östermalm", 27527229, 20, 0.0, wikidata="Q29024431", wikipedia="sv:Östermalm,_Västerås")],
    )
    assert (row.popindex, row.name, row.supercat, row.subcat, row.area, row.osm_ids) == (
        1, "Östermalm", "c", "place", 0.0, "N27527229",
    )
    assert row.geometry.gtype == "POINT" and coordinates(row) == [(1.0, 1.0)]


def test_nulls_and_order(spark):
    admin = {"key": "boundary", "value": "administrative"}
    rows = elems(
        spark,
        [
            Place(None, 1, 1), Place("", 2, 2), Place("3", 3, None), Place("4", 4, 29), Place("5", 5, 28),
            Place("6", 6, 27, **admin), Place("7", 7, 26, level=4, **admin),
        ],
    )
    assert [r.name for r in rows] == ["7", "6", "5", "4", "3"]
    assert [r.subcat for r in rows[:2]] == ["state", "border"]


ORDER = [
    Place("mid", 3, 30, 1.0, wikipedia="mid"),
    Place("last", 1, 29, 0.0, wikipedia="last"),
    Place("next to last", 2, 29, None, wikipedia="next to last"),
    Place("first", 4, 0, 1.0, wikipedia="first"),
]


@pytest.mark.parametrize(
    "mode, tail", [("rank_only", ["next to last", "last"]), ("zero", ["last", "next to last"])]
)
def test_order_with_missing_importance(spark, mode, tail):
    rows = elems(spark, ORDER, null_importance=mode)
    assert [r.name for r in rows] == ["first", "mid", *tail]


def test_order_of_rejected_pages(spark):
    rows = elems(
        spark,
        [
            Place("1", 1, 10, 1.0, wikipedia="1"), Place("2", 2, 10, 1.0, wikipedia="x"),
            Place("3", 3, 0, 1.0, wikipedia="3"),
        ],
    )
    assert [r.name for r in rows] == ["3", "1", "2"]


def test_same_object(spark):
    rows = elems(
        spark,
        [Place("a", 1), Place("b", 1, osm_type="W"), Place("c", 2), Place("d", 2, osm_type="W"), Place("e", 1)],
    )
    assert len(rows) == 4


def test_same_wikidata(spark):
    def place(name, page, item, **more):
        return Place(name, int(name), wikidata=item, wikipedia=page, **{"shape": "POINT(5 5)", **more})

    rows = elems(
        spark,
        [
            place("1", "1", "wd1"), place("2", "2", "wd1"), place("3", "1", "wd3"),
            place("4", "1", "wd1", rank=0, shape=POINT), place("5", "5", "wd5", rank=1),
        ],
    )
    assert len(rows) == 3
    assert rows[0].name == "4" and coordinates(rows[0]) == [(1.0, 1.0)]


def test_same_everything_and_picks(spark):
    shapes = [(None, "POINT(1 11)"), (None, "POINT(2 22)"), (1.0, "POINT(3 33)"), (0.1, "POINT(4 44)")]
    nodes = [Place("nodes", n + 11, 20, i, wikipedia="nodes", shape=s) for n, (i, s) in enumerate(shapes)]
    shapes = [
        (1.0, POINT), (None, line((2, 2), (9, 9))), (0.5, line((3, 3), (9, 9))), (0.1, line((4, 4), (9, 9))),
    ]
    lines = [Place("lines", 21, 20, i, wikipedia="lines", shape=s) for i, s in shapes]
    same = [
        Place("same", 1, 0, wikidata="w", wikipedia="same"), Place("same", 1), Place("same", 2, wikidata="w"),
        Place("same", 3, wikipedia="same"), Place("same", 1, wikidata="w", wikipedia="same"),
    ]
    found = {r.name: r for r in elems(spark, [*nodes, *lines, *same])}
    assert len(found) == 3
    assert coordinates(found["nodes"]) == [(3.0, 33.0)] and found["nodes"].osm_ids == "N13"
    assert coordinates(found["lines"])[0] == (3.0, 3.0)


def test_place_id_as_key_meets_wikidata(spark):
    """A row without wikidata is grouped under its place id, also with an item of that very name."""
    rows = [Place("1", 1, 5, wikidata="52"), Place("2", 2, 9)]
    assert [r.name for r in elems(spark, rows, first_id=51)] == ["1"]
    assert [r.name for r in elems(spark, rows, first_id=61)] == ["1", "2"]


def test_id_of_an_equal_geometry_in_an_earlier_group(spark):
    # the page group gives the geometry; the object group holds an equal one, of a less important row
    rows = [
        Place("1", 1, 0, 1.0, wikipedia="1", wikidata="a", shape=POINT),
        Place("1", 1, 29, 0.0, shape=LINE),
        Place("1", 2, 5, 0.5, wikipedia="1", wikidata="b", shape=LINE),
    ]
    (row,) = elems(spark, rows)
    assert row.geometry.gtype == "LINESTRING" and row.osm_ids == "N1"


def test_unknown_key(spark):
    with pytest.raises(Exception, match="not in the key table: XXXXXXX"):
        elems(spark, [Place("1", 1, key="XXXXXXX")])
    assert elems(spark, [Place("1", 1, key="XXXXXXX")], on_unknown="drop") == []


def test_categories(spark):
    expected = {
        ("aerialway", "x", None): ("c", "aerialway"),
        ("club", "x", None): ("c", "club hangout"),
        ("highway", "x", None): ("r", "highway"),
        ("natural", "x", None): ("n", "natural"),
        ("waterway", "stream", None): ("n", "waterway"),
        ("amenity", "place_of_worship", None): ("c", "place of worship"),
        ("place", "islet", None): ("n", "island"),
        ("boundary", "national_park", None): ("n", "national park"),
        ("boundary", "administrative", None): ("c", "border"),
        ("boundary", "administrative", 0): ("c", "border"),
        ("boundary", "administrative", 1): ("c", "continent"),
        ("boundary", "administrative", 8): ("c", "city"),
    }
    places = [Place(str(n), n + 1, n, key=k, value=v, level=a) for n, (k, v, a) in enumerate(expected)]
    assert [(r.supercat, r.subcat) for r in elems(spark, places)] == list(expected.values())


def test_pick_tag_of_several(spark):
    def rows(name, first, tags):
        return [
            Place(name, first, 20, key=k, value=v) for k, v in tags
        ]

    found = elems(
        spark,
        rows("a", 1, [("landuse", "x"), ("waterway", "x"), ("highway", "x")])
        + rows("b", 2, [("historic", "x"), ("waterway", "waterfall"), ("boundary", "administrative")]),
    )
    assert {r.name: r.subcat for r in found} == {"a": "highway", "b": "waterfall"}


MIXED = [
    Place("1", 1, 1, shape=POINT), Place("1", 2, 2, shape=line((1, 1), (2, 2))),
    Place("1", 3, 4, shape=line((2, 2), (3, 3))), Place("1", 4, 3, shape=line((3, 3), (4, 4))),
    Place("1", 5, 5, shape=SQUARE),
    Place("2", 6, 1, shape=POINT), Place("2", 7, 16, shape=line((1, 1), (2, 2))),
    Place("2", 8, 10, shape=line((2, 2), (3, 3))), Place("2", 9, 15, shape=line((3, 3), (4, 4))),
    Place("2", 10, 11, shape=SQUARE),
]


def test_mixed_geometries(spark):
    found = elems(spark, MIXED)
    assert {r.name: r.geometry.gtype for r in found} == {"1": "POLYGON", "2": "MULTILINESTRING"}
    found = elems(spark, MIXED, geometry_pairing="as_documented")
    assert {r.name: r.geometry.gtype for r in found} == {"1": "MULTILINESTRING", "2": "MULTILINESTRING"}


def test_lines(spark):
    g = 99 / PER_DEGREE[0]
    cases = {
        "1": ([[(-1, 0), (0, 0)], [(0, 0), (1, 0)]], 2),
        "2": ([[(-1e-6, 0), (0, 0)], [(g, 0), (1e-6 + g, 0)]], 2),
        "3": ([[(-3, 0), (0, 0)], [(g, 0), (3, 0)]], 2),
        "4": ([[(-1, 0), (0, 0)], [(0, 0), (0, 1)]], 2),
        "5": ([[(-1, 0), (1, 0)], [(0, 0), (0, 1)]], 3),
        "6": ([[(0, -1), (0, 1)], [(g, 0), (1, 0)]], 2),
        "7": ([[(0, -1), (0, 1)], [(1, 0), (g, 0)]], 2),
        "8": ([[(-1, -1), (1, 1)], [(-1, 1), (1, -1)]], 4),
        "9": ([[(0, 0), (1, 1)], [(1, 1), (0, 0)]], 1),
        "10": ([[(0, 0), (1, 1)], [(1, 1), (2, 2)], [(2, 2), (3, 3)]], 3),
        "11": ([[(-2, 0), (-1, 0)], [(-1, 0), (0, 0)], [(g, 1), (g, 0)]], 3),
    }
    places, number = [], 0
    for rank, (name, (lines, _)) in enumerate(cases.items(), 1):
        for xy in lines:
            number += 1
            places.append(Place(name, number, rank, shape=line(*xy)))
    places.append(Place("0", number + 1, 30, shape=LINE))
    places.append(Place("0", number + 2, 0, value="country", shape=LINE))
    found = elems(spark, places)
    assert [r.name for r in found] == ["0", *cases]
    assert found[0].subcat == "country" and found[0].osm_ids == f"N{number + 2},N{number + 1}"
    for row in found[1:]:
        assert parts(row) == cases[row.name][1], row.name
        assert row.geometry.gtype == ("LINESTRING" if parts(row) == 1 else "MULTILINESTRING")
    assert len(coordinates(found[1])) == 4
    assert len(coordinates([r for r in found if r.name == "9"][0])) == 2


def test_lines_out_of_range(spark):
    d = 101 / PER_DEGREE[0]
    assert len(elems(spark, [Place("1", 1, shape=line((-1, 0), (0, 0))), Place("1", 2, shape=line((d, 0), (1, 0)))])) == 2


def test_complex(spark):
    far = "LINESTRING(1 1,101 1)"
    common = {"wikidata": "100", "wikipedia": "100"}
    first = [Place("1", 1, 1, wikidata="1", wikipedia="1", shape=LINE)] * 2
    second = [Place("1", 2, 1, wikidata="2", wikipedia="2", shape=LINE)] * 2
    ten = [
        Place("10", 10, 2, key="historic", wikidata="10", wikipedia="10", shape=LINE),
        Place("10", 10, 2, key="highway", wikidata="10", wikipedia="10", shape=LINE),
        Place("10", 11, 2, key="natural", wikidata="11", wikipedia="11", shape=LINE),
    ]
    hundred = [Place("100", 100, 15, key="historic", shape=LINE, **common)] * 3
    rest = [
        Place("101", 1010101010, None, key="natural", wikipedia="101", shape=LINE),
        Place("100", 101, 0, key="natural", wikipedia="101", shape=far),
        Place("100", 102, 29, key="highway", shape=LINE),
    ]
    found = elems(spark, [*first, *second, *ten, *hundred, *rest])
    # the row named 101 keeps to itself: its page is not one the rows named 100 pass the test for
    assert [r.name for r in found] == ["100", "1", "10", "101"]
    assert (found[0].subcat, found[0].osm_ids, parts(found[0])) == ("highway", "N101,N100,N102", 2)
    assert len(coordinates(found[0])) == 4
    assert found[1].osm_ids == "N1,N2" and coordinates(found[1]) == [(1, 1), (2, 2)]
    assert (found[2].subcat, found[2].osm_ids) == ("highway", "N10,N11")


def test_latitudes(spark):
    places, expected = [], {}
    for lat, inside, outside in [(0, 99, 101), (30, 85, 90), (60, 50, 55), (85, 8, 10)]:
        for meters, objects in ((inside, 1), (outside, 2)):
            name = f"{lat} {meters}"
            expected[name] = objects
            for x in (0, meters / PER_DEGREE[lat]):
                places.append(Place(name, len(places) + 1, shape=f"POINT({x} {lat})"))
    assert Counter(r.name for r in elems(spark, places)) == expected


def test_clusters_end_to_end(spark):
    """Chains link through neighbours, polygons reach what lies in them."""
    step = 90 / PER_DEGREE[0]
    chain = [Place("chain", n + 1, shape=f"POINT({n * step} 0)") for n in range(60)]
    far = [Place("chain", 900, shape=f"POINT({62 * step} 0)")]
    park = [
        Place("park", 901, 1, shape="POLYGON((10 10,11 10,11 11,10 11,10 10),(10.4 10.4,10.6 10.4,10.6 10.6,10.4 10.6,10.4 10.4))"),
        Place("park", 902, 2, shape="POINT(10.2 10.3)"),
        Place("park", 903, 3, shape="POINT(10.5 10.5)"),
        Place("park", 904, 4, shape="POLYGON((10.7 10.7,10.8 10.7,10.8 10.8,10.7 10.7))"),
    ]
    found = elems(spark, [*chain, *far, *park])
    sizes = sorted((r.name, r.n_ids) for r in found)
    assert sizes == [("chain", 1), ("chain", 60), ("park", 1), ("park", 3)]
    assert math.isclose([r.area for r in found if r.name == "park" and r.n_ids == 3][0], 0.005)


def test_long_id_lists_continue_on_pages(spark, monkeypatch):
    monkeypatch.setattr(rank, "ID_PAGE", 4)
    places = [Place("many", n + 1, n) for n in range(10)] + [Place("few", 50 + n, n) for n in range(3)]
    built = build_elems(table(spark, places)).orderBy("popindex", "page").collect()
    many = [r for r in built if r.name == "many"]
    assert [(r.page, r.osm_ids, r.n_ids) for r in many] == [(0, "N1,N2,N3,N4", 10), (1, "N5,N6,N7,N8", 10), (2, "N9,N10", 10)]
    assert [r.geometry is None for r in many] == [False, True, True] and len({r.popindex for r in many}) == 1
    assert [(r.page, r.osm_ids) for r in built if r.name == "few"] == [(0, "N50,N51,N52")]


def test_nearby_objects_keep_all_ids(spark, monkeypatch):
    """``dedupe_nearby`` lists every member of a cluster, of however many pages."""
    monkeypatch.setattr(rank, "ID_PAGE", 4)
    places = [Place("many", n + 1, n) for n in range(10)] + [Place("few", 50 + n, n) for n in range(3)] + [Place("one", 70)]
    monkeypatch.setattr(queries.fixtures, "places", lambda spark, sf: table(spark, places))
    found = queries.dedupe_nearby(spark, "").collect()
    assert {r.name: (r.n, r.ids) for r in found} == {"many": (10, "N1,N2,N3,N4,N5,N6,N7,N8,N9,N10"), "few": (3, "N50,N51,N52"), "one": (1, "N70")}


def test_ties_go_by_all_pages_of_ids(spark):
    rows = [(1, 9, 1.0, list("aa"), 5), (2, 8, 1.0, list("aa"), 4), (3, 7, 1.0, list("aa"), 2), (4, 6, 1.0, list("aa"), 4), (5, 5, 2.0, ["z"], 1), (6, 4, 1.0, list("aa"), 5)]
    objects = spark.createDataFrame(rows, "cid long, place_id long, importance double, ids array<string>, n long")
    more = [(1, 1, list("bb")), (1, 2, ["d"]), (2, 1, list("bb")), (4, 1, list("ba")), (6, 1, list("bb")), (6, 2, ["c"])]
    pages = spark.createDataFrame([(r[0], 0, r[3]) for r in rows] + more, "cid long, page long, ids array<string>")
    ranked = rank.with_popindex(objects, pages).orderBy("popindex").collect()
    assert [(r.popindex, r.cid) for r in ranked] == [(1, 5), (2, 3), (3, 4), (4, 2), (5, 6), (6, 1)]
