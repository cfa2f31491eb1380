"""Small hand-written place tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from placeforge.functions.formats import from_ewkt
from placeforge.plans.elems import Options, build_elems

POINT = "POINT(1 1)"
LINE = "LINESTRING(1 1,2 2)"
SQUARE = "POLYGON((1 1,2 1,2 2,1 2,1 1))"


@dataclass
class Place:
    name: str | None
    osm_id: int
    rank: int | None = 20
    importance: float | None = None
    osm_type: str = "N"
    key: str = "place"
    value: str = "suburb"
    level: int | None = None
    wikidata: str | None = None
    wikipedia: str | None = None
    shape: str = POINT


SCHEMA = """place_id long, importance double, rank_search short, osm_id long, osm_type string, class string,
 type string, name map<string,string>, admin_level short, extratags map<string,string>, wikipedia string, ewkt string"""


def table(spark, places: list[Place], first_id: int = 5001):
    rows = [
        (
            first_id + n, p.importance, p.rank, p.osm_id, p.osm_type, p.key, p.value,
            None if p.name is None else {"name": p.name}, p.level,
            None if p.wikidata is None else {"wikidata": p.wikidata}, p.wikipedia, p.shape,
        )
        for n, p in enumerate(places)
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("geometry", from_ewkt(F.col("ewkt"))).drop("ewkt")


def elems(spark, places: list[Place], first_id: int = 5001, **options):
    """Built objects in order of rank."""
    return build_elems(table(spark, places, first_id), Options(**options)).orderBy("popindex").collect()


def parts(row) -> int:
    return len(row.geometry.parts)


def coordinates(row) -> list[tuple[float, float]]:
    return [(p.x, p.y) for part in row.geometry.parts for ring in part for p in ring]
