"""Each registered query: (spark, folder of tables) to a DataFrame over the whole tables."""

from __future__ import annotations

import struct
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge import fixtures
from placeforge.functions import arrays, formats, geometry, scoring, text
from placeforge.functions.geometry import Area
from placeforge.operators import category, cluster, kernels, lines, merge, overlay, rank
from placeforge.operators.ordered import position_in_group
from placeforge.plans import audit, elems, serve, tags
from placeforge.session import work_dir
from placeforge.sources import category_tables, labels, snippets, tables

BOX = Area([(6.20025, 0.05005), (6.60045, 0.05005), (6.60045, 0.25035), (6.20025, 0.25035)])
# an L: the box above without its upper right part
ELL = Area([
    (6.20025, 0.05005), (6.60045, 0.05005), (6.60045, 0.15035), (6.40015, 0.15035), (6.40015, 0.25035),
    (6.20025, 0.25035),
])
# a comb of twelve teeth with a slot in its back: 51 corners, and 4 of the hole
_X = [6.20025 + 0.0166 * i for i in range(25)]
COMB = Area(
    [(_X[0], 0.05005), (_X[24], 0.05005)]
    + [p for i in range(23, 0, -2) for p in ((_X[i + 1], 0.15015), (_X[i + 1], 0.25035), (_X[i], 0.25035), (_X[i], 0.15015))]
    + [(_X[0], 0.15015)],
    [[(_X[3], 0.08005), (_X[20], 0.08005), (_X[20], 0.12005), (_X[3], 0.12005)]],
)
AREA_DIGITS = 12


def _geom() -> Column:
    return F.col("geometry")


def _digits(value: Column, n: int = AREA_DIGITS) -> Column:
    return F.round(value, n)


def _described(df: DataFrame) -> list[Column]:
    """Kind and box of a geometry, for comparison."""
    box = geometry.bounds(_geom())
    return [_geom()["gtype"].alias("gtype"), *[v.alias(k) for k, v in box.items()]]


# ---- functions ----

def to_importance(spark: SparkSession, sf: str) -> DataFrame:
    i, r = F.col("importance"), F.col("rank_search")
    return fixtures.places(spark, sf).select(
        "place_id",
        scoring.to_importance(i, r).alias("zero"),
        scoring.to_importance(i, r, null_importance="rank_only").alias("rank_only"),
        scoring.to_importance(None, r).alias("no_page"),
        scoring.browse_score(i, r).alias("browse"),
        scoring.browse_score(i, r, fill=False).alias("browse_unfilled"),
    )


def test_wikipedia(spark: SparkSession, sf: str) -> DataFrame:
    name = audit.place_name()
    return fixtures.places(spark, sf).select(
        "place_id", name.alias("name"), text.unaccent(name).alias("folded"),
        text.test_wikipedia(name, F.col("wikipedia")).alias("wikipedia"),
    )


def web_links(spark: SparkSession, sf: str) -> DataFrame:
    object_id = text.to_id(F.col("osm_type"), F.col("osm_id"))
    return fixtures.places(spark, sf).select(
        "place_id", object_id.alias("id"),
        text.to_web(F.col("osm_type"), F.col("osm_id")).alias("web"),
        text.id_to_web(object_id).alias("id_web"),
        text.ids_to_webs(F.concat_ws(",", object_id, F.concat(F.lit("N"), F.col("place_id").cast("string")))).alias("webs"),
    )


def array_functions(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    o = F.col("o_orderkey").cast("long")
    values = F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: (o + i * 7) % 23)
    ids = F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: (((o + i * i) % 5)).cast("string"))
    levels = F.array(F.when(o % 2 == 0, o % 16), F.when(o % 3 == 0, o % 7), o % 5)
    rows = orders.select(o.alias("k"), values.alias("v"), ids.alias("i"), levels.alias("l"))
    return rows.select(
        "k",
        arrays.text_of(arrays.with_unique_id(F.col("v"), F.col("i")).cast("array<string>")).alias("unique_values"),
        arrays.text_of(F.col("l").cast("array<string>")).alias("without_nulls"),
        arrays.text_of(arrays.fill_nulls(F.col("l"), -1).cast("array<string>")).alias("filled"),
        arrays.at_position_of(F.col("v"), F.col("i"), F.lit("3")).alias("at_three"),
        F.octet_length(arrays.text_of(F.col("i"))).alias("bytes"),
    )


def unnest_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrays side by side to rows."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    o = F.col("o_orderkey").cast("long")
    pairs = F.arrays_zip(F.array(o % 3, o % 5, o % 7).alias("x"), F.array(o + 1, o + 2, o + 3).alias("y"))
    return orders.select(o.alias("k"), F.inline(pairs))


def meters_to_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.places(spark, sf).select(
        "place_id", _digits(geometry.degrees_of_meters(F.lit(100.0), F.col("miny") * 100), 9).alias("degrees")
    )


# ---- geometry ----

def geometry_measures(spark: SparkSession, sf: str) -> DataFrame:
    g = _geom()
    moved = geometry.to_mercator(g)
    return fixtures.places(spark, sf).select(
        "place_id", *_described(g),
        geometry.num_points(g).alias("points"), geometry.num_parts(g).alias("parts"),
        geometry.first_point(g)["x"].alias("x0"), geometry.first_point(g)["y"].alias("y0"),
        _digits(geometry.area(g)).alias("area"), _digits(geometry.length(g)).alias("length"),
        _digits(geometry.first_point(moved)["x"], 3).alias("mx"), _digits(geometry.first_point(moved)["y"], 3).alias("my"),
    )


def _against(spark: SparkSession, sf: str, polygon: Area) -> DataFrame:
    g = _geom()
    return fixtures.places(spark, sf).select(
        "place_id",
        geometry.intersects(g, polygon).alias("touches"),
        _digits(geometry.intersection_area(g, polygon)).alias("overlap"),
        geometry.in_working_area(g, geometry.area(g), polygon).alias("inside"),
    )


def area_of_box(spark: SparkSession, sf: str) -> DataFrame:
    return _against(spark, sf, BOX)


def area_of_ell(spark: SparkSession, sf: str) -> DataFrame:
    return _against(spark, sf, ELL)


def area_of_comb(spark: SparkSession, sf: str) -> DataFrame:
    """Overlap with an area that is far from convex and has a hole."""
    return fixtures.places(spark, sf).select("place_id", _digits(geometry.intersection_area(_geom(), COMB)).alias("overlap"))


def probe_area(spark: SparkSession, sf: str) -> DataFrame:
    found = serve.probe(fixtures.places(spark, sf), BOX)
    return found.withColumn("overlap", _digits(F.col("overlap"))).withColumn("area", _digits(F.col("area")))


def overlap_parts(spark: SparkSession, sf: str) -> DataFrame:
    """What a box with a hole and a line share with the comb's teeth, for each order: kinds, parts, rings, measures."""
    o = F.col("o_orderkey").cast("long")
    rows = fixtures.spread(spark.read.parquet(f"{sf}/orders.parquet").select(o.alias("o")))
    x, w = 6.1500037 + F.col("o") % 1000 / 2000, 0.0010011 + F.col("o") % 13 / 100
    hole_x, hole_w = x + w * 0.25, w * 0.5

    def ring(x0: Column, y0: float, x1: Column, y1: float) -> Column:
        at = lambda px, py: geometry.point_xy(px, F.lit(py))
        return F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0))

    framed = geometry.geometry(F.lit("POLYGON"), F.array(F.array(ring(x, 0.16, x + w, 0.24), ring(hole_x, 0.19, hole_x + hole_w, 0.21))))
    line = geometry.make_line(F.array(geometry.point_xy(x, F.lit(0.2)), geometry.point_xy(x + w, F.lit(0.2))))
    shapes = rows.select("o", framed.alias("box"), line.alias("line"))
    shared = shapes.select("o", overlay.overlap(F.col("box"), COMB).alias("b"), overlay.overlap(F.col("line"), COMB).alias("l"))
    part, way = F.col("b.geometry"), F.col("l.geometry")
    return shared.select(
        "o", F.col("b.kind").alias("kind"), geometry.num_parts(part).alias("parts"), F.size(geometry.rings(part)).alias("rings"),
        _digits(geometry.area(part)).alias("area"), F.col("l.kind").alias("line_kind"), geometry.num_parts(way).alias("line_parts"),
        _digits(geometry.length(way)).alias("line_length"),
    )


def valid_geometries(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and broken shapes on every place: bow ties, holes outside, lines of one point, holes that touch once or twice."""
    x, y, kind = F.col("minx"), F.col("miny"), F.col("place_id") % 8

    def at(dx: float, dy: float) -> Column:
        return geometry.point_xy(x + dx, y + dy)

    def ring(*offsets: tuple[float, float]) -> Column:
        return F.array(*[at(*o) for o in offsets])

    square = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    hook = ring((1, 1), (3, 1), (3, 1.5), (1.5, 1.5), (1.5, 2.5), (3, 2.5), (3, 3), (1, 3), (1, 1))
    shape = (
        F.when(kind == 0, geometry.geometry(F.lit("POLYGON"), F.array(F.array(square))))
        .when(kind == 1, geometry.geometry(F.lit("POLYGON"), F.array(F.array(ring((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))))))
        .when(kind == 2, geometry.geometry(F.lit("POLYGON"), F.array(F.array(square, ring((1, 1), (2, 1), (2, 2), (1, 1))))))
        .when(kind == 3, geometry.geometry(F.lit("POLYGON"), F.array(F.array(square, ring((3, 3), (6, 3), (6, 6), (3, 3))))))
        .when(kind == 4, geometry.make_line(ring((0, 0), (0, 0))))
        .when(kind == 6, geometry.geometry(F.lit("POLYGON"), F.array(F.array(square, hook, ring((3, 1.5), (3.5, 2), (3, 2.5), (3.25, 2), (3, 1.5))))))
        .when(kind == 7, geometry.geometry(F.lit("POLYGON"), F.array(F.array(square, hook, ring((3, 1.5), (3.5, 1.5), (3.5, 2), (3, 1.5))))))
        .otherwise(geometry.make_line(ring((0, 0), (1, 1))))
    )
    shapes = fixtures.places(spark, sf).select("place_id", shape.alias("geometry"))
    return shapes.select("place_id", kernels.is_valid(_geom()).alias("valid"))


def simplify_to_points(spark: SparkSession, sf: str) -> DataFrame:
    """Five peaked lines for each order, thinned to 13 points in all: the highest peaks stay, equal ones go together."""
    o = F.col("o_orderkey").cast("long")
    at = lambda x, y: geometry.point_xy(F.lit(float(x)), y)
    zero = F.lit(0.0)
    peaked = [F.array(F.array(at(0, zero), at(1, ((o * (k + 3)) % 11 + 1) / 10), at(2, zero))) for k in range(5)]
    rows = fixtures.spread(spark.read.parquet(f"{sf}/orders.parquet").select(o.alias("o_orderkey")))
    shapes = rows.select(F.col("o_orderkey").alias("o"), geometry.geometry(F.lit("MULTILINESTRING"), F.array(*peaked)).alias("geometry"))
    return shapes.select("o", kernels.simplify_to(_geom(), 13).alias("geometry")).select(
        "o", geometry.num_points(_geom()).alias("points"), _digits(geometry.length(_geom()), 9).alias("length")
    )


def _zigzag(spark: SparkSession, sf: str) -> DataFrame:
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(39)),
        lambda i: geometry.point_xy(
            F.col("minx") + i * 0.001, F.col("miny") + ((F.col("place_id") * 31 + i * i * 17) % 13) * 0.0001
        ),
    )
    return fixtures.places(spark, sf).select("place_id", geometry.make_line(steps).alias("geometry"))


def simplify_peaks(spark: SparkSession, sf: str) -> DataFrame:
    """A line with one peak for each place; the peak stays where it is higher than the tolerance."""
    high = (F.col("place_id") % 7).cast("double")
    peak = geometry.make_line(F.array(*[geometry.point_xy(F.lit(x), y) for x, y in ((0.0, F.lit(0.0)), (50.0, high), (100.0, F.lit(0.0)))]))
    rows = fixtures.places(spark, sf).select("place_id", peak.alias("geometry"))
    return rows.select("place_id", geometry.num_points(kernels.simplify(_geom(), 3.5)).alias("points"))


def simplify(spark: SparkSession, sf: str) -> DataFrame:
    return _zigzag(spark, sf).select(
        "place_id",
        geometry.num_points(_geom()).alias("points"),
        geometry.num_points(kernels.simplify(_geom(), 0.0005)).alias("thinned"),
        geometry.num_points(kernels.simplify_to(_geom(), 10)).alias("at_most_ten"),
    )


def text_formats(spark: SparkSession, sf: str) -> DataFrame:
    g = _geom()
    rows = fixtures.places(spark, sf)
    pair = F.concat(F.lit('"name"=>"'), audit.place_name(), F.lit('", "ref"=>NULL, "wikidata"=>"'), F.col("extratags")["wikidata"], F.lit('"'))
    store = formats.from_hstore(pair)
    return rows.select(
        "place_id", formats.to_ewkt(g).alias("ewkt"), formats.to_geojson(g).alias("geojson"),
        (formats.from_ewkt(formats.to_ewkt(g)) == g).alias("same"),
        store["name"].alias("name"), store["wikidata"].alias("wikidata"), F.size(F.map_keys(store)).alias("keys"),
    )


# ---- categories ----

def binary_geometries(spark: SparkSession, sf: str) -> DataFrame:
    """A binary form made of each order and read again: all kinds, both byte orders, with SRID and height, and broken ones."""
    o = F.col("o")
    quarters = {end: F.array(*[F.lit(struct.pack(end + "d", i / 4).hex()) for i in range(16)]) for end in "<>"}

    def number(i: Column | int, end: str) -> Column:
        return F.try_element_at(quarters[end], (F.lit(i) % 16 + 1).cast("int"))

    def head(code: int, end: str, srid: bool = False) -> str:
        return struct.pack(end + "BI", end == "<", code | (0x20000000 if srid else 0)).hex() + (struct.pack(end + "I", 4326).hex() if srid else "")

    def run(points: list[tuple], end: str, counted: bool = True, high: bool = False) -> Column:
        count = [F.lit(struct.pack(end + "I", len(points)).hex())] if counted else []
        return F.concat(*count, *[number(v, end) for p in points for v in ((*p, 3) if high else p)])

    def made(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    count = lambda n, end: struct.pack(end + "I", n).hex()
    way, side = [(o + i, o * 3 + i) for i in range(3)], o % 8 + 8
    shell, hole, corner = [(0, 0), (side, 0), (side, side), (0, side), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)], [(12, 12), (15, 12), (15, 15), (12, 12)]
    framed = lambda end: made(head(3, end), count(2, end), run(shell, end), run(hole, end))
    point = made(head(1, "<"), run(way[:1], "<", False))
    forms = [
        point,
        made(head(2 | 0x80000000, ">", True), run(way, ">", True, True)),
        framed("<"),
        made(head(4, ">", True), count(2, ">"), head(1, ">"), run(way[:1], ">", False), head(1, "<"), run(way[1:2], "<", False)),
        made(head(5, "<"), count(2, "<"), head(2, "<"), run(way, "<"), head(2, ">"), run(way[:2], ">")),
        made(head(6, ">", True), count(2, ">"), framed("<"), head(3, ">"), count(1, ">"), run(corner, ">")),
        F.when(o % 2 == 0, F.left(point, F.length(point) - 2)).otherwise("zz"),
    ]
    text = F.coalesce(*[F.when(o % 7 == i, f) for i, f in enumerate(forms)])
    rows = fixtures.spread(spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("long").alias("o"))).select("o", text.alias("text"))
    read = rows.select("o", "text", kernels.from_ewkb_hex(F.col("text")).alias("geometry"))
    g = _geom()
    return read.select(
        "o", g["gtype"].alias("gtype"), geometry.num_parts(g).alias("parts"), geometry.num_points(g).alias("points"),
        F.when(g.isNotNull(), _digits(geometry.area(g))).alias("area"), geometry.first_point(g)["x"].alias("x"), kernels.ewkb_error(F.col("text"), g).alias("error"),
    )


def category_of_places(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.places(spark, sf).select("place_id", "class", "type", "admin_level")
    return category.with_category(rows)


def pick_tag(spark: SparkSession, sf: str) -> DataFrame:
    """The tag picked among those of a customer's neighbours in the key order: arrays within a row."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    o = F.col("o_orderkey").cast("long")
    keys = [k[0] for k in category_tables.KEYS]
    tags_ = F.array(*[
        F.struct(
            n.cast("int").alias("prio"), fixtures.pick(keys, n).alias("class"),
            fixtures.pick(fixtures.TYPES, (o + m) % len(fixtures.TYPES)).alias("type"),
            ((o + m) % 16).cast("int").alias("admin_level"),
        )
        for m, n in enumerate([o % 25, (o * 7 + 3) % 25, (o * 3 + 11) % 25, o % 25])
    ])
    return orders.select(o.alias("k"), F.inline(F.array(category.pick_tag(tags_))))


def category_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Category table lines, one per place, parsed as an override table and as a key table."""
    places = fixtures.places(spark, sf)
    sub = F.when(F.col("place_id") % 3 == 0, "1").when(F.col("place_id") % 3 == 1, "2").otherwise("other")
    rows = places.select(F.col("place_id").alias("no"), F.concat_ws(" ", "class", "type", F.lit("c"), sub).alias("value"))
    overrides = category_tables.parse_override_table(rows)
    short = places.select(
        F.col("place_id").cast("int").alias("no"),
        F.concat_ws(" ", "class", F.lit("n"), F.when(F.col("place_id") % 2 == 0, F.col("type"))).alias("value"),
    )
    keys = category_tables.parse_key_table(short)
    return overrides.select(F.lit("override").alias("form"), F.lit(None).cast("int").alias("prio"), "*").union(
        keys.select(F.lit("key"), "prio", "key", F.lit(None).cast("string"), "supercat", "subcat")
    )


def label_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Label lines of the places' tags, parsed, with the audit of labels that do not restate the tag."""
    own = F.when(F.col("place_id") % 9 == 0, F.lit("Something Else")).otherwise(labels.default_label(F.col("type")))
    lines_ = fixtures.places(spark, sf).select(
        F.concat(F.col("class"), F.lit(" "), F.col("type"), F.lit(" '"), own, F.lit("'")).alias("value")
    )
    odd = labels.parse_labels(labels.odd_labels(lines_)).groupBy("class", "type", "label").agg(F.count("*").alias("odd"))
    every = labels.parse_labels(lines_).groupBy("class", "type", "label").agg(F.count("*").alias("n"))
    return every.join(odd, ["class", "type", "label"], "left").select("class", "type", "label", "n", F.coalesce("odd", F.lit(0)).alias("odd"))


def interesting_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys compared between the markers of small source texts, one text per place."""
    def compared(key: Column) -> Column:
        return F.concat(F.lit('} else if (strcmp(k, "'), key, F.lit('") == 0) {'))

    text_ = F.concat_ws(
        "\n", compared(F.lit("before")), F.lit(snippets.START), compared(F.col("class")), F.lit("places.add(k, v);"),
        F.lit(snippets.STOP), compared(F.col("type")),
    )
    texts = fixtures.places(spark, sf).select(text_.alias("value"))
    return snippets.interesting_keys(snippets.between_markers(texts))


# ---- merge ----

def prepare(spark: SparkSession, sf: str) -> DataFrame:
    return merge.prepare(fixtures.places(spark, sf)).drop("geometry")


def group_positions(spark: SparkSession, sf: str) -> DataFrame:
    return audit.group_positions(fixtures.places(spark, sf))


def merge_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Position of each prepared row in its three groups, most important first."""
    rows = merge.in_groups(elems.prepared_rows(fixtures.places(spark, sf)))
    placed = position_in_group(rows.select("kind", "key", "o", "place_id"), ["kind", "key"], [F.col("o"), F.col("place_id")])
    return placed.select("kind", "key", "place_id", "pos")


def merged_members(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merged_members(elems.prepared_rows(fixtures.places(spark, sf))).drop("digest")


def merge_same_entity(spark: SparkSession, sf: str) -> DataFrame:
    merged = elems.merged_objects(fixtures.places(spark, sf))
    return merged.select(
        "place_id", "name", "importance", "prio", "class", "type", "admin_level", "id", *_described(merged)
    )


# ---- clusters and ranks ----

def cluster_nearby(spark: SparkSession, sf: str) -> DataFrame:
    return elems.clustered_objects(fixtures.places(spark, sf)).members.select("place_id", "nk", "cid")


def cluster_all_places(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of the unmerged places, 20 m apart at most."""
    named = merge.prepare(fixtures.places(spark, sf)).select("place_id", "name", "geometry")
    return cluster.cluster_nearby(named, 20.0).select("place_id", "cid")


def dedupe_nearby(spark: SparkSession, sf: str) -> DataFrame:
    found = rank.with_all_ids(elems.collapsed_objects(fixtures.places(spark, sf)))
    return found.select(
        "cid", "name", "importance", "class", "type", "admin_level", "n", arrays.text_of(F.col("ids")).alias("ids")
    )


def cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of each cluster in order, one row each."""
    rows = elems.clustered_objects(fixtures.places(spark, sf)).members.select("cid", "importance", "id", "place_id")
    return position_in_group(rows, ["cid"], [F.desc("importance"), F.col("id"), F.col("place_id")])


def merge_linestrings(spark: SparkSession, sf: str) -> DataFrame:
    """Union of the lines of each customer: its parts and their total length."""
    rows = fixtures.places(spark, sf).filter(F.col("geometry.gtype") == "LINESTRING")
    grouped = rows.select(F.floor(F.col("osm_id") / 20).alias("grp"), F.col("place_id").alias("line"), "geometry")
    g = _geom()
    return lines.union_lines(grouped).select(
        "grp", g["gtype"].alias("gtype"), geometry.num_parts(g).alias("parts"), _digits(geometry.length(g), 9).alias("length")
    )


def slanted_roads(spark: SparkSession, sf: str) -> DataFrame:
    """United roads of two customers each: a slanted spine, and for each order a spur that ends on it or a road across.

    Spurs and crossings lie where rounding puts them, mostly a hair off the spine.
    """
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    o, grp = F.col("o_orderkey").cast("long"), F.floor(F.col("o_custkey").cast("long") / 2)
    x0, y0, share = 6 + F.col("grp") % 50 / 10, F.col("grp") % 7 / 10, F.col("o") % 96 + 1
    mx, my, deep = x0 + F.lit(0.6) * share / 97, y0 + F.lit(0.3) * share / 97, F.lit(0.004) * (F.col("o") % 3 + 1)
    spine = F.array(geometry.point_xy(x0, y0), geometry.point_xy(x0 + 0.6, y0 + 0.3))
    spur = F.array(geometry.point_xy(mx, my), geometry.point_xy(mx + 0.002, my - deep))
    across = F.array(geometry.point_xy(mx - 0.001, my - 0.002), geometry.point_xy(mx + 0.001, my + 0.002))
    shapes = F.array_compact(F.array(spine, spur, F.when(F.col("o") % 5 == 0, across)))
    rows = fixtures.spread(orders.select(o.alias("o"), grp.alias("grp"))).select("grp", "o", F.posexplode(shapes).alias("i", "pts"))
    g = _geom()
    united = lines.union_lines(rows.select("grp", (F.col("o") * 3 + F.col("i")).alias("line"), geometry.make_line(F.col("pts")).alias("geometry")))
    return united.select("grp", "page", g["gtype"].alias("gtype"), geometry.num_parts(g).alias("parts"), _digits(geometry.length(g), 9).alias("length"))


def build_elems(spark: SparkSession, sf: str) -> DataFrame:
    built = elems.build_elems(fixtures.places(spark, sf))
    return built.select(
        "popindex", "page", "name", "supercat", "subcat", _geom()["gtype"].alias("gtype"),
        _digits(F.col("area")).alias("area"), "osm_ids", "minx", "miny", "maxx", "maxy",
    )


def stored_elems(spark: SparkSession, sf: str) -> DataFrame:
    """The objects as written, checked and read back."""
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/elems-{uuid.uuid4().hex}"
    tables.write_elems(elems.build_elems(fixtures.places(spark, sf)), path)
    stored = spark.read.parquet(path)
    tables.check_elems(stored)
    return stored.select("popindex", "page", "name", "supercat", "subcat", _geom()["gtype"].alias("gtype"), "osm_ids")


def build_elems_other_modes(spark: SparkSession, sf: str) -> DataFrame:
    """The build with missing importances scored by rank, and the most important member's geometry."""
    options = elems.Options(null_importance="rank_only", geometry_pairing="as_documented")
    built = elems.build_elems(fixtures.places(spark, sf), options)
    return built.select("popindex", "name", "supercat", "subcat", _geom()["gtype"].alias("gtype"), "osm_ids")


def cluster_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The concatenated tag lists of every object, a row per entry."""
    return elems.object_tags(fixtures.places(spark, sf))


def object_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists as text."""
    return elems.tag_texts(elems.object_tags(fixtures.places(spark, sf)))


def replace_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every place with its customer's united lines in place of a line, by ascending importance."""
    rows = fixtures.places(spark, sf).select(
        F.floor(F.col("osm_id") / 20).alias("grp"), F.col("place_id").alias("line"),
        F.coalesce("importance", F.lit(0.0)).alias("importance"), "geometry",
    )
    g = _geom()
    return lines.merge_linestrings(rows).select(
        "grp", "line", "importance", "pos", g["gtype"].alias("gtype"), geometry.num_parts(g).alias("parts")
    )


def pick_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """The geometry picked from three made of each place: a point, a line and a box, with scores by arithmetic."""
    x, y, o = F.col("minx"), F.col("miny"), F.col("place_id")
    shapes = F.array(
        geometry.make_point(x, y), geometry.make_line(F.array(geometry.point_xy(x, y), geometry.point_xy(x + 1, y))),
        geometry.make_box(x, y, x + 1, y + 1), geometry.make_point(x + 1, y),
    )
    some = F.slice(shapes, (o % 4 + 1).cast("int"), (o % 3 + 1).cast("int"))
    scores = F.transform(some, lambda g, n: ((o * (n + 3)) % 5).cast("double"))
    rows = fixtures.places(spark, sf).select(o, some.alias("g"), scores.alias("s"))
    picked = geometry.pick_geometry(F.col("g"), F.col("s"))
    return rows.select("place_id", picked.alias("geometry")).select("place_id", _geom()["gtype"].alias("gtype"), geometry.first_point(_geom())["x"].alias("x"))


# ---- serving ----

def area_matches(spark: SparkSession, sf: str) -> DataFrame:
    built = elems.build_elems(fixtures.places(spark, sf))
    return serve.area_matches(built, BOX).select("popindex", serve.listing_line().alias("line"))


def query_area(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/elems-{uuid.uuid4().hex}"
    tables.write_elems(elems.build_elems(fixtures.places(spark, sf)), path)
    return serve.query_stored(spark, path, BOX, after=5).select("popindex", "name", "supercat", "subcat", "osm_ids")


def prepared_in_area(spark: SparkSession, sf: str) -> DataFrame:
    """Area query straight on scored places, without merging."""
    rows = merge.prepare(fixtures.places(spark, sf))
    inside = rows.filter(geometry.in_working_area(_geom(), geometry.area(_geom()), BOX))
    return category.with_category(inside.select("place_id", "id", "name", "imp_order", "class", "type", "admin_level")).orderBy(
        F.desc("imp_order"), "place_id"
    )


# ---- reports ----

def same_object_report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.page_texts(audit.same_object_report(fixtures.places(spark, sf)), ["osm_type", "osm_id"], ["name", "score"])


def same_wikipedia_report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.page_texts(audit.same_wikipedia_report(fixtures.places(spark, sf)), ["wikipedia"], ["name", "web"])


def same_wikidata_report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.page_texts(audit.same_wikidata_report(fixtures.places(spark, sf)), ["wikidata"], ["name", "importance", "web"])


def same_name_report(spark: SparkSession, sf: str) -> DataFrame:
    built = elems.build_elems(fixtures.places(spark, sf))
    return audit.page_texts(audit.same_name_report(built), ["name"], ["popindex", "supercat", "subcat", "osm_ids"])


def repeated_objects(spark: SparkSession, sf: str) -> DataFrame:
    return audit.repeated_keys(fixtures.places(spark, sf), ["osm_type", "osm_id"])


def ranks_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return audit.ranks_by_name(elems.build_elems(fixtures.places(spark, sf)))


def first_of_object(spark: SparkSession, sf: str) -> DataFrame:
    return audit.first_of_object(fixtures.places(spark, sf))


def classes_so_far(spark: SparkSession, sf: str) -> DataFrame:
    return audit.classes_so_far(fixtures.places(spark, sf))


def running_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists on every place of its object's rows, up to the place and whole."""
    return audit.object_lists(fixtures.places(spark, sf))


def object_entries(spark: SparkSession, sf: str) -> DataFrame:
    return audit.object_entries(fixtures.places(spark, sf))


def names_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.names_summary(fixtures.places(spark, sf))


def reference_systems(spark: SparkSession, sf: str) -> DataFrame:
    """Systems in metres, of one made for each part."""
    unit = F.when(F.col("p_partkey") % 3 == 0, 'UNIT["degree",0.0174]').otherwise('UNIT["metre",1]')
    systems = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").cast("long").alias("srid"), unit.alias("srtext"))
    return audit.reference_systems(systems, r'UNIT\["metre"')


def rejected_wikipedia(spark: SparkSession, sf: str) -> DataFrame:
    return audit.rejected_wikipedia(fixtures.places(spark, sf))


def widest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return audit.widest_rows(fixtures.places(spark, sf), F.col("place_id"))


def count_larger_than(spark: SparkSession, sf: str) -> DataFrame:
    return audit.count_larger_than(fixtures.places(spark, sf), 1)


def most_points(spark: SparkSession, sf: str) -> DataFrame:
    return audit.most_points(fixtures.places(spark, sf))


def top_name(spark: SparkSession, sf: str) -> DataFrame:
    return audit.top_name(fixtures.places(spark, sf))


def browse(spark: SparkSession, sf: str) -> DataFrame:
    return audit.browse(fixtures.places(spark, sf))


def place_details(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.place_details(fixtures.places(spark, sf), "São Tomé 1")
    return found.withColumn("wikidata", F.col("extratags")["wikidata"]).drop("extratags")


def names_matching(spark: SparkSession, sf: str) -> DataFrame:
    return audit.names_matching(fixtures.places(spark, sf), "st.*m")


# ---- tags ----

def tagged_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Objects with a handful of tags each, by arithmetic on the order key."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    o, c = F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long")

    def tag(key: Column | str, value: Column | str, condition: Column) -> Column:
        k = F.lit(key) if isinstance(key, str) else key
        v = F.lit(value) if isinstance(value, str) else value
        return F.when(condition, F.struct(k.alias("k"), v.alias("v")))

    candidates = F.array(
        tag("source", "survey", o % 4 == 0),
        tag("name", F.concat(F.lit("Place "), c.cast("string")), o % 3 != 0),
        tag("name:sv", "Plats", o % 9 == 1),
        tag("ref", o.cast("string"), o % 5 == 0),
        tag("brand:wikidata", "Q1", o % 8 == 0),
        tag("addr:housename", "The House", o % 31 == 0),
        tag("highway", fixtures.pick(["footway", "residential", "crossing", "no"], o % 4), o % 7 == 0),
        tag("footway", "sidewalk", o % 2 == 0),
        tag("natural", fixtures.pick(["tree", "coastline", "yes"], o % 3), o % 11 == 0),
        tag("landuse", fixtures.pick(["cemetry", "forest"], o % 2), o % 6 == 0),
        tag("junction", "roundabout", o % 10 == 0),
        tag("boundary", fixtures.pick(["administrative", "postal"], o % 2), o % 13 == 0),
        tag("place", fixtures.pick(["city", "island", "hamlet"], o % 3), o % 12 < 3),
        tag("amenity", fixtures.pick(["cafe", "no"], c % 2), o % 17 == 0),
        tag("admin_level", fixtures.pick(["4", "0", "x", "8a", "99"], o % 5), o % 3 == 0),
        tag("addr:postcode", F.concat(F.lit("7"), (c % 1000).cast("string")), o % 5 == 1),
        tag("postal_code", "00000", o % 10 == 1),
        tag("addr:country", fixtures.pick(["se", "swe"], o % 2), o % 4 == 1),
        tag("addr:interpolation", "even", o % 37 == 0),
        tag("addr:housenumber", (c % 90).cast("string"), o % 6 == 5),
        tag("is_in:state", "Here", o % 19 == 0),
        tag("wheelchair", "yes", o % 14 == 0),
        tag("building", "yes", o % 5 == 2),
    )
    return orders.select(
        F.when(o % 3 == 0, "N").when(o % 3 == 1, "W").otherwise("R").alias("osm_type"), o.alias("osm_id"),
        F.array_compact(candidates).alias("tags"),
    )


def classify_tags(spark: SparkSession, sf: str) -> DataFrame:
    def listed(pairs: Column) -> Column:
        return F.array_join(F.array_sort(F.transform(pairs, lambda t: F.concat(t["k"], F.lit("="), t["v"]))), ",")

    found = tags.classify_tags(tagged_objects(spark, sf))
    entries = F.transform(F.map_entries("address"), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))
    return found.select(
        "osm_id", listed(F.col("places")).alias("places"), listed(F.col("names")).alias("names"),
        listed(F.col("extratags")).alias("extratags"), listed(entries).alias("address"), "admin_level",
    )


def place_rows(spark: SparkSession, sf: str) -> DataFrame:
    found = tags.place_rows(tagged_objects(spark, sf), unnamed_drop_keys=["natural"])
    return found.select("osm_type", "osm_id", "class", "type", "admin_level")


QUERIES = {
    f.__name__: f
    for f in [
        to_importance, test_wikipedia, web_links, array_functions, unnest_pairs, meters_to_degrees,
        geometry_measures, area_of_box, area_of_ell, area_of_comb, probe_area, overlap_parts, valid_geometries, simplify, simplify_peaks, simplify_to_points, text_formats, binary_geometries,
        category_of_places, pick_tag, category_lines, label_lines, interesting_keys,
        prepare, group_positions, merge_positions, merged_members, merge_same_entity,
        cluster_nearby, cluster_all_places, dedupe_nearby, cluster_members, merge_linestrings, slanted_roads, replace_lines, pick_geometry,
        build_elems, stored_elems, build_elems_other_modes, cluster_lists, object_lists, area_matches, query_area, prepared_in_area,
        same_object_report, same_wikipedia_report, same_wikidata_report, same_name_report, repeated_objects,
        ranks_by_name, first_of_object, classes_so_far, running_lists, object_entries, names_summary, reference_systems, rejected_wikipedia, widest_rows, count_larger_than,
        most_points, top_name, browse, place_details, names_matching, classify_tags, place_rows,
    ]
}
