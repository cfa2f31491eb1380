"""Serving ranked objects by area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.functions.geometry import (
    Area, area, bounds, in_working_area, intersection_area, intersects, near_area,
)
from placeforge.operators.overlay import overlap
from placeforge.sources.tables import MANIFEST

PAGE_SIZE = 10
FILES_AT_ONCE = 16  # files of a stored table read in the first round; each round reads twice as many, up to the next
MOST_FILES_AT_ONCE = 1024


def area_matches(elems: DataFrame, polygon: Area, after: int = 0) -> DataFrame:
    """Rows of objects past ``after`` that touch the area, polygons only with half of themselves inside it.

    A large object is found by any of its pages; the rows are those pages that touch the area.
    """
    if "minx" not in elems.columns:
        elems = elems.select("*", *[v.alias(k) for k, v in bounds(F.col("geometry")).items()])
    # the range tests reach the parquet scan; only what is left pays for the exact test
    past = F.col("popindex") > after
    return elems.filter(past & near_area(polygon)).filter(in_working_area(F.col("geometry"), F.col("area"), polygon))


def query_area(elems: DataFrame, polygon: Area, after: int = 0, count: int = PAGE_SIZE) -> DataFrame:
    """The next ``count`` objects inside the area, most important first, with all their pages in order.

    Reads ``elems`` twice, so it should be a written table; see ``query_stored`` for one on disk.
    """
    found = area_matches(elems, polygon, after).select("popindex").distinct().orderBy("popindex").limit(count)
    # at most ``count`` rows
    return elems.join(F.broadcast(found), "popindex").select(*elems.columns).orderBy("popindex", "page")


def find_ranks(
    spark: SparkSession, path: str, polygon: Area, after: int = 0, count: int = PAGE_SIZE, files_at_once: int = FILES_AT_ONCE
) -> tuple[list[int], list[str]]:
    """(the next ``count`` ranks inside the area of a stored table, the files that were read for them).

    Files whose box touches the area are read in rounds by their smallest rank past ``after``, until no unread file can
    hold a smaller rank than those found. A round takes the names of its own files to the driver, and at most ``count`` ranks.
    """
    first = F.greatest("first", F.lit(after + 1)).alias("first")
    files = spark.read.parquet(f"{path}/{MANIFEST}").filter((F.col("last") > after) & near_area(polygon)).select(first, "file")
    ranks: list[int] = []
    read: list[str] = []
    done = (0, "")
    while True:
        full = len(ranks) == count
        unread = files.filter((F.col("first") > done[0]) | ((F.col("first") == done[0]) & (F.col("file") > done[1])))
        if full:
            unread = unread.filter(F.col("first") < ranks[-1])
        some = unread.orderBy("first", "file").limit(files_at_once).collect()
        if not some:
            return ranks, read
        names = [r["file"] for r in some]
        rows = area_matches(spark.read.parquet(*names), polygon, after).select("popindex")
        if full:
            rows = rows.filter(F.col("popindex") < ranks[-1])
        new = {r["popindex"] for r in rows.distinct().orderBy("popindex").limit(count).collect()}
        ranks = sorted(new.union(ranks))[:count]
        read += names
        done = (some[-1]["first"], some[-1]["file"])
        files_at_once = min(2 * files_at_once, MOST_FILES_AT_ONCE)


def query_stored(spark: SparkSession, path: str, polygon: Area, after: int = 0, count: int = PAGE_SIZE) -> DataFrame:
    """``query_area`` on a table that ``write_elems`` has written, which reads only the files it needs."""
    ranks, read = find_ranks(spark, path, polygon, after, count)
    wanted = F.col("popindex").isin(ranks)
    if not ranks:
        return spark.read.parquet(path).limit(0)
    # further pages of an object may lie in any file that has such pages and covers its rank
    files = spark.read.parquet(f"{path}/{MANIFEST}").filter("last_page > 0")
    if files.filter((F.col("first") <= ranks[-1]) & (F.col("last") >= ranks[0])).isEmpty():
        rows = spark.read.parquet(*read)
    else:
        rows = spark.read.parquet(path)  # the ranks reach the scan
    return rows.filter(wanted).orderBy("popindex", "page")


def listing_line() -> Column:
    """``popindex. name. supercat. subcat. ids``"""
    return F.format_string("%s. %s. %s. %s. %s", "popindex", "name", "supercat", "subcat", "osm_ids")


def probe(places: DataFrame, polygon: Area) -> DataFrame:
    """Every place against one area: kind of geometry, does it touch, area and kind of the overlap."""
    geom = F.col("geometry")
    return places.select(
        "place_id",
        F.left(F.col("name")["name"], F.lit(30)).alias("name"),
        geom["gtype"].alias("gtype"),
        intersects(geom, polygon).alias("touches"),
        intersection_area(geom, polygon).alias("overlap"),
        overlap(geom, polygon)["kind"].alias("overlap_type"),
        area(geom).alias("area"),
    )
