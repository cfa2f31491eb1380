"""The whole build: places to ranked, categorised, de-duplicated objects."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.functions.arrays import text_of
from placeforge.functions.geometry import area, bounds
from placeforge.functions.scoring import DEFAULT_FACTOR
from placeforge.functions.text import unaccent
from placeforge.operators.category import with_category
from placeforge.operators.cluster import DEFAULT_EPS, nearby_components, with_components
from placeforge.operators.merge import merge_same_entity, merged_members, narrow, prepare
from placeforge.operators.ordered import PAGE
from placeforge.operators.rank import Collapsed, cluster_tags, collapse, with_first_ids, with_popindex, with_shape_kinds
from placeforge.session import durable

COLUMNS = ["popindex", "page", "name", "supercat", "subcat", "geometry", "area", "osm_ids"]


class Options(NamedTuple):
    """Choices of a build; see the README."""

    factor: float = DEFAULT_FACTOR
    null_importance: str = "zero"
    geometry_pairing: str = "as_written"
    eps: float = DEFAULT_EPS
    on_unknown: str = "fail"
    keys: DataFrame | None = None
    overrides: DataFrame | None = None


def prepared_rows(places: DataFrame, options: Options = Options()) -> DataFrame:
    return durable(narrow(prepare(places, options.factor, options.null_importance, options.keys)), "prepared")


def merged_objects(places: DataFrame, options: Options = Options(), rows: DataFrame | None = None) -> DataFrame:
    """Survivors of the merge by OSM id, wikidata and wikipedia, before nearby ones are clustered."""
    return merge_same_entity(prepared_rows(places, options) if rows is None else rows, places)


class Clusters(NamedTuple):
    """``members`` with ``nk`` and ``cid`` but without geometry; ``geometries`` by place id."""

    members: DataFrame
    geometries: DataFrame


def clustered_objects(places: DataFrame, options: Options = Options(), rows: DataFrame | None = None) -> Clusters:
    merged = durable(merged_objects(places, options, rows), "merged")
    named = merged.withColumn("nk", unaccent(F.col("name")))
    found = nearby_components(named.select("place_id", "nk", "geometry"), options.eps)
    members = durable(with_components(with_shape_kinds(named), found), "clustered")
    return Clusters(members, merged.select("place_id", "geometry"))


def collapsed_objects(places: DataFrame, options: Options = Options()) -> Collapsed:
    clusters = clustered_objects(places, options)
    return collapse(clusters.members, clusters.geometries, options.geometry_pairing)


def object_tags(places: DataFrame, options: Options = Options()) -> DataFrame:
    """(popindex, pos, class, type, admin_level): the concatenated tag lists of every object, a row per entry."""
    rows = prepared_rows(places, options)
    clusters = clustered_objects(places, options, rows)
    collapsed = collapse(clusters.members, clusters.geometries, options.geometry_pairing)
    ranks = with_popindex(with_first_ids(collapsed), collapsed.ids).select("cid", "popindex")
    tags = cluster_tags(clusters.members, merged_members(rows)).join(ranks, "cid")
    return tags.select("popindex", "pos", "class", "type", "admin_level")


def tag_texts(tags: DataFrame, page: int = PAGE) -> DataFrame:
    """(popindex, page, classes, types, admin_levels): those lists as text, in pages; a missing level is -1."""
    values = {"classes": F.col("class"), "types": F.col("type"), "admin_levels": F.coalesce("admin_level", F.lit(-1))}
    texts = tags.select("popindex", "pos", *[v.cast("string").alias(k) for k, v in values.items()])
    paged = texts.groupBy("popindex", F.floor((F.col("pos") - 1) / page).alias("page"))
    lists = paged.agg(F.array_sort(F.collect_list(F.struct("pos", *values))).alias("l"))
    return lists.select("popindex", "page", *[F.array_join(F.col(f"l.{k}"), ",").alias(k) for k in values])


def build_elems(places: DataFrame, options: Options = Options()) -> DataFrame:
    """Ranked objects with the columns of ``COLUMNS``, the box of each row's geometry and the number of ids.

    An object is a row of page 0, and further pages if its ids or the points of its united lines need them. Each row
    has the object's name and category; a page without ids or without geometry has null there.
    """
    collapsed = collapsed_objects(places, options)
    ranked = with_popindex(with_first_ids(collapsed), collapsed.ids).drop("ids")
    named = with_category(ranked, options.keys, options.overrides, options.on_unknown)
    pages = collapsed.shapes.join(collapsed.ids, ["cid", "page"], "full")
    geom = F.col("geometry")
    return named.join(pages, "cid").select(
        "popindex", "page", "name", "supercat", "subcat", "geometry",
        area(geom).alias("area"), text_of(F.col("ids")).alias("osm_ids"),
        *[v.alias(k) for k, v in bounds(geom).items()],
        F.col("n").alias("n_ids"),
    )
