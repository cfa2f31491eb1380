"""Collapsing clusters to one object each, and ranking the objects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.functions.geometry import num_points
from placeforge.operators.lines import union_lines
from placeforge.operators.ordered import list_pages, position_in_group, position_in_table
from placeforge.session import durable

ID_PAGE = 10_000  # ids in one row; longer lists continue on further pages


class Collapsed(NamedTuple):
    """``objects`` one row per cluster; ``shapes`` (cid, page, geometry) and ``ids`` (cid, page, ids) in pages.

    Every cluster has a page 0 of both, and as many further pages as it takes.
    """

    objects: DataFrame
    shapes: DataFrame
    ids: DataFrame


def with_shape_kinds(objects: DataFrame) -> DataFrame:
    """Objects with ``is_node`` (a single point) and ``is_line`` in place of the geometry."""
    geom = F.col("geometry")
    return objects.select(
        *[c for c in objects.columns if c != "geometry"],
        (num_points(geom) <= 1).alias("is_node"),
        (geom["gtype"] == "LINESTRING").alias("is_line"),
    )


def pick_members(clustered: DataFrame, geometry_pairing: str = "as_written") -> DataFrame:
    """Per cluster: its most important member, the tag, and the member that gives the geometry.

    A member that is not a single point is preferred for the geometry: the least important such one with
    ``geometry_pairing='as_written'``, the most important one with ``'as_documented'``.
    """
    signs = {"as_written": 1, "as_documented": -1}
    rows = clustered.select(
        "cid", "place_id", "name", "importance", "prio", "class", "type", "admin_level", "id", "is_node", "is_line",
        (-F.col("importance")).alias("o"),
        (F.lit(float(signs[geometry_pairing])) * F.col("importance")).alias("g"),
    )
    return rows.groupBy("cid").agg(
        F.min(F.struct("o", "id", "place_id", "name", "importance")).alias("first"),
        F.min(F.struct("prio", "o", "id", "place_id", "class", "type", "admin_level")).alias("tag"),
        F.min(F.struct("is_node", "g", "id", "place_id", "is_line")).alias("shape"),
        F.count("*").alias("n"),
        F.sum(F.col("is_line").cast("long")).alias("n_lines"),
    )


def _shapes(clustered: DataFrame, geometries: DataFrame, picked: DataFrame) -> DataFrame:
    """(cid, page, geometry): the picked member's own, or the union of all lines when that is a line."""
    united = F.col("shape.is_line") & (F.col("n_lines") > 1)
    own = picked.filter(~united).select("cid", F.col("shape.place_id").alias("place_id"))
    shapes = own.join(geometries, "place_id").select("cid", F.lit(0).cast("long").alias("page"), "geometry")
    lines = (
        clustered.filter("is_line")
        .join(picked.filter(united).select("cid"), "cid", "left_semi")
        .select(F.col("cid").alias("grp"), F.col("place_id").alias("line"), "place_id")
        .join(geometries, "place_id")
    )
    return shapes.union(union_lines(lines).select(F.col("grp").alias("cid"), "page", "geometry"))


def _ids(clustered: DataFrame, picked: DataFrame) -> DataFrame:
    """(cid, page, ids): the members' ids by descending importance. A lone member is its own list."""
    alone = picked.filter("n = 1").select("cid", F.lit(0).cast("long").alias("page"), F.array("first.id").alias("ids"))
    members = clustered.select("cid", "importance", "id", "place_id").join(picked.filter("n > 1").select("cid"), "cid", "left_semi")
    keys = [F.desc("importance"), F.col("id"), F.col("place_id")]
    pages = list_pages(members, ["cid"], keys, ["id"], ID_PAGE)
    return durable(alone.union(pages.select("cid", "page", F.col("items")["id"].alias("ids"))), "ids")


def collapse(clustered: DataFrame, geometries: DataFrame, geometry_pairing: str = "as_written") -> Collapsed:
    """One row per cluster: ``cid, name, importance``, size and the picked tag; its geometry and its ids.

    ``clustered`` are members without geometry (see ``with_shape_kinds``), ``geometries`` theirs by place id.
    """
    picked = durable(pick_members(clustered, geometry_pairing), "picked")
    ids = _ids(clustered, picked)
    objects = picked.select(
        "cid", "n",
        F.col("first.place_id").alias("place_id"), F.col("first.name").alias("name"),
        F.col("first.importance").alias("importance"),
        F.col("tag.prio").alias("prio"), F.col("tag.class").alias("class"), F.col("tag.type").alias("type"),
        F.col("tag.admin_level").alias("admin_level"),
    )
    return Collapsed(objects, _shapes(clustered, geometries, picked), ids)


def with_first_ids(collapsed: Collapsed) -> DataFrame:
    """The objects with the first page of their ``ids``, as ``with_popindex`` takes them."""
    return collapsed.objects.join(collapsed.ids.filter("page = 0").select("cid", "ids"), "cid")


def with_all_ids(collapsed: Collapsed) -> DataFrame:
    """The objects with the ``ids`` of all pages in one list."""
    pages = collapsed.ids.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("page", "ids"))).alias("pages"))
    return collapsed.objects.join(pages.select("cid", F.flatten("pages.ids").alias("ids")), "cid")


def cluster_tags(clustered: DataFrame, entries: DataFrame) -> DataFrame:
    """(cid, pos, class, type, admin_level): the tags of all members of a cluster, in the order of the members.

    ``entries`` are what each member gathered when rows of one object were merged (``merge.merged_members``), so a lone
    row counts three times, as in its merged lists.
    """
    members = clustered.select("cid", "importance", "id", F.col("place_id").alias("survivor"))
    tags = entries.select("survivor", F.col("pos").alias("entry"), "class", "type", "admin_level")
    order = [F.desc("importance"), F.col("id"), F.col("survivor"), F.col("entry")]
    placed = position_in_group(members.join(tags, "survivor"), ["cid"], order)
    return placed.select("cid", "pos", "class", "type", "admin_level")


def _tie_order(objects: DataFrame, ids: DataFrame) -> DataFrame:
    """(cid, tie): the order of objects of one importance and one first page of ids, by their further pages.

    Goes on to the next page until no two objects with a further page are left together.
    """
    long_ = objects.filter(F.col("n") > F.size("ids")).select("cid", F.xxhash64("importance", "ids").alias("g"), "importance", F.col("ids").alias("head"))
    same = long_.groupBy("g", "importance", "head").agg(F.count("*").alias("m")).filter("m > 1").select("g", "importance", "head")
    tied = durable(long_.join(same, ["g", "importance", "head"]).select("cid", "g", F.lit(0).alias("tie")), "ties")
    page = 0
    while not tied.isEmpty():
        page += 1
        more = tied.join(ids.filter(F.col("page") == page).select("cid", "ids"), "cid", "left")
        group = W.partitionBy("g").orderBy("tie", F.col("ids").asc_nulls_first())
        tied = durable(more.select("cid", "g", F.dense_rank().over(group).alias("tie"), F.col("ids").isNull().alias("over")), "ties")
        open_ = tied.groupBy("g", "tie").agg(F.count("*").alias("m"), F.min("over").alias("over")).filter("m > 1 and not over")
        if open_.isEmpty():
            break
        tied = tied.drop("over")
    return tied.select("cid", "tie")


def with_popindex(objects: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds ``popindex``: 1 for the most important object; ties by all ids, then place id.

    ``objects`` hold the first page of ``ids``.
    """
    ties = _tie_order(objects, ids)
    ranked = objects.join(ties, "cid", "left").withColumn("tie", F.coalesce("tie", F.lit(0)))
    head = F.slice("ids", F.lit(1), F.lit(4))
    long_ = F.size("ids") > 4
    order = [F.desc("importance"), F.col("ids"), F.col("tie"), F.col("place_id")]
    # partition bounds are sampled to the driver, so they use the first ids only; that agrees with the
    # order, as equal heads of four ids or fewer mean equal lists
    spread = [F.desc("importance"), head, long_, F.when(~long_, F.col("place_id"))]
    return position_in_table(ranked, order, "popindex", spread).drop("tie")
