"""Place rows derived from the ``orders`` table, for tests, benchmarks and registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.functions.geometry import make_box, make_line, make_point, point_xy
from placeforge.sources.category_tables import KEYS

TYPES = [
    "city", "island", "river", "waterfall", "administrative", "national_park", "place_of_worship", "yes",
    "residential", "hotel", "islet", "tram_stop",
]
NAMES = [
    "São Tomé", "Sao Tome", "Ôbo", "Obo", "Östermalm", "Main Street", "High_Street", "", "100% Gulch",
]


def pick(values: list[str], index: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _box_columns(o: Column, c: Column) -> dict[str, Column]:
    base_x = 6000000 + ((c - c % 2) % 100) * 10000 + (o % 10) * 400
    base_y = ((c - c % 2) % 37) * 10000
    kind = o % 3
    wide = F.when(kind == 0, 0).when(kind == 1, 500).otherwise(600)
    high = F.when(kind == 2, 600).otherwise(0)
    million = F.lit(1e6)
    return {
        "minx": base_x.cast("double") / million,
        "miny": base_y.cast("double") / million,
        "maxx": (base_x + wide).cast("double") / million,
        "maxy": (base_y + high).cast("double") / million,
    }


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all task slots, where a small file would be read by few tasks."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= slots else rows.repartition(slots)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One place per order; three in ten share a folded name and a location with others."""
    o, c = F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long")
    orders = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey"))
    stem = pick(NAMES, c % 10)
    suffix = ((c % 40 - c % 10) / 10).cast("int").cast("string")
    page = F.concat(F.lit("en:"), F.replace(stem, F.lit(" "), F.lit("_")), F.lit("_"), suffix)
    boxed = orders.select(
        o.alias("place_id"),
        F.when(o % 3 == 0, "N").when(o % 3 == 1, "W").otherwise("R").alias("osm_type"),
        (c * 10 + o % 2 + 1).alias("osm_id"),
        F.when(o % 4 != 0, ((o * 7919) % 1000).cast("double") / F.lit(1e3)).alias("importance"),
        F.when(o % 11 != 0, ((o * 13) % 31).cast("smallint")).alias("rank_search"),
        pick([k[0] for k in KEYS], o % len(KEYS)).alias("class"),
        pick(TYPES, (o * 7) % len(TYPES)).alias("type"),
        F.when(o % 6 != 0, (o % 16).cast("smallint")).alias("admin_level"),
        F.when(stem == "", F.lit("")).otherwise(F.concat(stem, F.lit(" "), suffix)).alias("plain_name"),
        F.when(o % 5 == 0, F.concat(F.lit("Q"), (c % 700).cast("string"))).alias("wikidata"),
        F.when(o % 7 == 0, page).when(o % 7 == 1, "en:Other").alias("wikipedia"),
        *[v.alias(k) for k, v in _box_columns(o, c).items()],
    )
    x0, y0, x1, y1 = (F.col(k) for k in ("minx", "miny", "maxx", "maxy"))
    shape = (
        F.when(F.col("place_id") % 3 == 0, make_point(x0, y0))
        .when(F.col("place_id") % 3 == 1, make_line(F.array(point_xy(x0, y0), point_xy(x1, y0))))
        .otherwise(make_box(x0, y0, x1, y1))
    )
    return boxed.select(
        "place_id", "osm_type", "osm_id", "importance", "rank_search", "class", "type", "admin_level",
        F.when(F.col("plain_name").isNotNull(), F.create_map(F.lit("name"), "plain_name")).alias("name"),
        F.when(F.col("wikidata").isNotNull(), F.create_map(F.lit("wikidata"), "wikidata")).alias("extratags"),
        "wikipedia", shape.alias("geometry"), "minx", "miny", "maxx", "maxy",
    )
