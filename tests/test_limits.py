"""Inputs that must fail, and large or lopsided ones that must not."""

import random

import pytest
from pyspark.sql import functions as F

from placeforge.functions.geometry import Area, area, intersection_area, make_box, make_line, point_xy
from placeforge.functions.text import unaccent
from placeforge.operators.category import with_category
from placeforge.operators.components import connected_components
from placeforge.operators.kernels import is_valid
from placeforge.operators.skew import with_groups
from placeforge.plans import audit
from placeforge.sources import category_tables


def tags(spark, *rows):
    return spark.createDataFrame(list(rows), "class string, type string, admin_level smallint")


def test_unknown_keys_fail_even_where_no_column_is_read(spark):
    rows = tags(spark, ("shop", "bakery", None), ("no such key", "x", None))
    with pytest.raises(Exception, match="not in the key table: no such key"):
        with_category(rows).count()
    assert with_category(rows, on_unknown="drop").count() == 1
    own = spark.createDataFrame([("no such key", "x", "n", "y")], "key string, value string, supercat string, subcat string")
    with pytest.raises(Exception, match="not in the key table"):
        with_category(rows, overrides=own).collect()


def test_repeated_keys_are_rejected(spark, tmp_path):
    path = tmp_path / "keys"
    path.write_text("// header\nshop c\nclub c\nshop n\n")
    with pytest.raises(ValueError, match="repeated key: shop"):
        category_tables.load_key_table(spark, str(path))
    own = spark.createDataFrame([(0, "shop", "c", "a"), (1, "shop", "n", "b")], "prio int, key string, supercat string, subcat string")
    with pytest.raises(ValueError, match="repeated key: shop"):
        with_category(tags(spark, ("shop", "x", None)), keys=own)


def test_line_of_many_equal_points(spark):
    def line(last):
        points = F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: point_xy(F.when(i == 100_000, last).otherwise(1.0), F.lit(2.0)))
        return make_line(points)

    row = spark.range(1).select(is_valid(line(1.0)).alias("same"), is_valid(line(1.5)).alias("moves")).first()
    assert (row.same, row.moves) == (False, True)


def test_area_of_many_corners(spark):
    """Boxes against a ragged area with a hole, by counting small squares."""
    rng = random.Random(4)
    heights = [rng.randint(3, 9) for _ in range(24)]
    shell = [(0, 0), (24, 0)] + [p for i in range(23, -1, -1) for p in ((i + 1, heights[i]), (i, heights[i]))]
    ragged = Area(shell, [[(2, 1), (20, 1), (20, 2), (2, 2)]])
    boxes = [(x, y, x + w, y + h) for x, y, w, h in ((rng.randint(-3, 22), rng.randint(-3, 9), rng.randint(1, 9), rng.randint(1, 7)) for _ in range(40))]
    full = lambda x, y: 0 <= x < 24 and 0 <= y < heights[x] and not (2 <= x < 20 and y == 1)
    rows = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(boxes)], "i int, a double, b double, c double, d double")
    shapes = rows.select("i", make_box(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("g"))
    found = {r.i: r.s for r in shapes.select("i", intersection_area(F.col("g"), ragged).alias("s")).collect()}
    for i, (a, b, c, d) in enumerate(boxes):
        assert found[i] == pytest.approx(sum(full(x, y) for x in range(a, c) for y in range(b, d)), abs=1e-9)
    convex = Area([(0, 0), (10, 0), (12, 5), (5, 9), (-2, 4)])
    inside = shapes.filter("i = 0").select(make_box(*map(F.lit, (2.0, 1.0, 5.0, 4.0))).alias("g"))
    assert inside.select(intersection_area(F.col("g"), convex) == area(F.col("g"))).first()[0]


def test_folding_of_signs_and_compatible_letters(spark):
    row = spark.range(1).select(unaccent(F.lit("O’Neill – Ё ﬁ № Ａ «x» Ångström ¼")).alias("t")).first()
    assert row.t == "O'Neill - Е fi No A <<x>> Angstrom  1/4"


@pytest.fixture
def no_help(spark):
    """Without broadcasts by size and without new plans at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_key_is_spread(spark, no_help):
    n = 40_000
    rows = spark.range(n).select("id", F.when(F.col("id") % 10 < 6, -1).otherwise(F.col("id") % 5000).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n")).cache()
    met = with_groups(rows, groups, ["k"], "n", n, F.col("id"))
    tasks = met.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("m"), F.sum("n").alias("s")).collect()
    assert sum(t.m for t in tasks) == n and max(t.m for t in tasks) < 0.2 * n
    assert met.filter("n is null").isEmpty() and met.filter("k = -1 and n <> 24000").isEmpty()
    report = audit.in_repeated_groups(rows, ["k"], [F.col("id")])
    assert report.count() == n
    groups.unpersist()


def test_components_of_a_star_and_a_chain(spark, no_help):
    star = [(0, i) for i in range(1, 3000)]
    chain = [(i, i + 1) for i in range(10_000, 10_200)]
    edges = spark.createDataFrame(star + chain, "u long, v long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert len(found) == 3000 + 201
    assert all(c == (0 if n < 3000 else 10_000) for n, c in found.items())
