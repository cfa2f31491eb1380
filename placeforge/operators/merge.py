"""Merging rows that describe one object: same OSM id, same wikidata item or same wikipedia page.

A row survives when it is the most important row of all three of its groups. It takes its tag, geometry
and id from the rows of those groups. Groups are only ever aggregated with partial aggregation, so their
size does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions.geometry import num_points
from placeforge.functions.scoring import DEFAULT_FACTOR, to_importance
from placeforge.functions.text import test_wikipedia, to_id
from placeforge.operators.category import with_key_prio
from placeforge.operators.kernels import is_valid
from placeforge.operators.ordered import position_in_group

SAME_OBJECT, SAME_WIKIDATA, SAME_WIKIPEDIA = 0, 1, 2


def _geometry_digest(geom: Column) -> Column:
    """128 bits that stand for exact equality of geometries."""
    return F.struct(F.xxhash64(geom).alias("a"), F.xxhash64(F.lit(1), geom).alias("b"))


def prepare(
    places: DataFrame,
    factor: float = DEFAULT_FACTOR,
    null_importance: str = "zero",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Named places with a valid geometry, scored. One row in, at most one row out; no shuffle."""
    name = F.col("name")["name"]
    usable = places.filter(
        F.col("name").isNotNull() & name.isNotNull() & (name != "") & F.col("geometry").isNotNull()
    ).filter(is_valid(F.col("geometry")))
    rows = usable.select(
        "place_id",
        to_id(F.col("osm_type"), F.col("osm_id")).alias("id"),
        name.alias("name"),
        "class", "type", "admin_level", "importance", "rank_search",
        F.col("extratags")["wikidata"].alias("wikidata"),
        test_wikipedia(name, F.col("wikipedia")).alias("wikipedia"),
        "geometry",
    )
    full = to_importance(F.col("importance"), F.col("rank_search"), factor, null_importance)
    by_rank = to_importance(None, F.col("rank_search"), factor, null_importance)
    scored = rows.select(
        "*",
        full.alias("imp_order"),
        F.when(F.col("wikipedia").isNotNull(), full).otherwise(by_rank).alias("imp_value"),
        (num_points(F.col("geometry")) <= 1).cast("int").alias("is_node"),
    ).drop("importance", "rank_search")
    return with_key_prio(scored, keys)


def narrow(prepared: DataFrame) -> DataFrame:
    """Prepared rows with a digest in place of the geometry: what the grouping reads."""
    return prepared.withColumn("digest", _geometry_digest(F.col("geometry"))).drop("geometry")


def _own_key() -> Column:
    """What stands for a missing key: the place id, as text."""
    return F.col("place_id").cast("string")


def in_groups(rows: DataFrame) -> DataFrame:
    """Each row once per group, three times in all: adds ``kind, key`` and ``o``, the score to sort ascending by."""
    groups = F.array(
        F.struct(F.lit(SAME_OBJECT).alias("kind"), F.col("id").alias("key")),
        F.struct(F.lit(SAME_WIKIDATA).alias("kind"), F.coalesce("wikidata", _own_key()).alias("key")),
        F.struct(F.lit(SAME_WIKIPEDIA).alias("kind"), F.coalesce("wikipedia", _own_key()).alias("key")),
    )
    return rows.select("*", F.inline(groups), (-F.col("imp_order")).alias("o"))


def _with_own_key_users(rows: DataFrame, column: str) -> DataFrame:
    """Adds ``own_<column>``: is the row without that key, and its place id the key of another row?"""
    name = f"own_{column}"
    spelled = rows.filter(F.col(column).rlike(r"^\d+$")).select(F.col(column).alias("key")).distinct()
    if spelled.isEmpty():
        return rows.withColumn(name, F.lit(False))
    ids = spelled.select(F.col("key").try_cast("long").alias("place_id"), "key")
    ids = ids.filter(F.col("place_id").cast("string") == F.col("key")).select("place_id", F.lit(True).alias(name))
    found = rows.join(ids, "place_id", "left")
    return found.withColumn(name, F.coalesce(name, F.lit(False)) & F.col(column).isNull())


def in_shared_groups(rows: DataFrame) -> DataFrame:
    """Each row once per group that can have other rows in it; adds ``kind, key, o`` and ``need``, their number.

    Most rows have no wikidata and no wikipedia page: the group of their own place id holds nothing their
    object's group lacks, so they are spared two of three places in the shuffle.
    """
    flagged = _with_own_key_users(_with_own_key_users(rows, "wikidata"), "wikipedia")

    def key(column: str) -> Column:
        return F.coalesce(column, F.when(F.col(f"own_{column}"), _own_key()))

    groups = F.filter(
        F.array(
            F.struct(F.lit(SAME_OBJECT).alias("kind"), F.col("id").alias("key")),
            F.struct(F.lit(SAME_WIKIDATA).alias("kind"), key("wikidata").alias("key")),
            F.struct(F.lit(SAME_WIKIPEDIA).alias("kind"), key("wikipedia").alias("key")),
        ),
        lambda g: g["key"].isNotNull(),
    )
    need = 1 + key("wikidata").isNotNull().cast("int") + key("wikipedia").isNotNull().cast("int")
    return flagged.select(*rows.columns, (-F.col("imp_order")).alias("o"), need.alias("need"), F.inline_outer(groups))


def group_winners(rows: DataFrame) -> DataFrame:
    """Per group: its first row, the tag picked from it and the geometry picked from it."""
    return (
        in_shared_groups(rows)
        .groupBy("kind", "key")
        .agg(
            F.min(F.struct("o", "place_id", "name", "imp_value", "need")).alias("first"),
            F.min(F.struct("prio", "o", "place_id", "class", "type", "admin_level")).alias("tag"),
            F.min(F.struct("is_node", "o", "place_id", "id", "digest")).alias("shape"),
        )
    )


def survivors(rows: DataFrame) -> DataFrame:
    """Rows that win all of their groups, with the best tag and geometry of them.

    Groups are taken in the order object, wikidata, wikipedia; earlier groups win ties.
    """
    def of(struct: str, *names: str) -> list[Column]:
        return [F.col(f"{struct}.{n}") for n in names]

    def key_of(kind: int) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("key"))).alias(f"key_{kind}")

    own = F.col("place_id").cast("string")
    return (
        group_winners(rows)
        .groupBy(F.col("first.place_id").alias("place_id"))
        .agg(
            F.count("*").alias("wins"),
            F.min(F.struct(*of("first", "name", "imp_value", "need"))).alias("own"),
            F.min(F.struct(*of("tag", "prio"), "kind", *of("tag", "class", "type", "admin_level"))).alias("tag"),
            F.min(
                F.struct(*of("shape", "is_node", "o"), "kind", *of("shape", "place_id", "id", "digest"))
            ).alias("shape"),
            *map(key_of, (SAME_OBJECT, SAME_WIKIDATA, SAME_WIKIPEDIA)),
        )
        .filter("wins = own.need")
        .withColumn("key_1", F.coalesce("key_1", own))
        .withColumn("key_2", F.coalesce("key_2", own))
    )


def _ids_of_equal_geometry(rows: DataFrame, won: DataFrame) -> DataFrame:
    """Ids of the first row with the picked geometry, where a group before the picked one has such a row."""
    late = won.filter(F.col("shape.kind") > SAME_OBJECT).select(
        F.col("place_id").alias("survivor"),
        F.col("shape.digest").alias("digest"),
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.lit(SAME_OBJECT).alias("kind"), F.col("key_0").alias("key")),
                    F.struct(F.lit(SAME_WIKIDATA).alias("kind"), F.col("key_1").alias("key")),
                ),
                lambda g: g["kind"] < F.col("shape.kind"),
            )
        ),
    )
    members = in_shared_groups(rows.select("place_id", "id", "wikidata", "wikipedia", "imp_order", "digest"))
    # the first row of each geometry of a group; combined before the rows meet, so a large group is no bottleneck
    firsts = members.filter(F.col("kind") < SAME_WIKIPEDIA).groupBy("kind", "key", "digest").agg(
        F.min(F.struct("o", "place_id", "id")).alias("f")
    )
    return (
        late.join(firsts, ["kind", "key", "digest"])
        .groupBy(F.col("survivor").alias("place_id"))
        .agg(F.min(F.struct("kind", "f"))["f"]["id"].alias("earlier_id"))
    )


def merge_same_entity(rows: DataFrame, places: DataFrame) -> DataFrame:
    """One row per surviving object.

    ``rows`` are narrow prepared rows (a durable table, as it is read twice); ``places`` provides the
    geometries, fetched only for the rows picked.
    """
    won = survivors(rows)
    merged = won.join(_ids_of_equal_geometry(rows, won), "place_id", "left").select(
        "place_id",
        F.col("own.name").alias("name"),
        F.col("own.imp_value").alias("importance"),
        F.col("tag.prio").alias("prio"),
        F.col("tag.class").alias("class"),
        F.col("tag.type").alias("type"),
        F.col("tag.admin_level").alias("admin_level"),
        F.coalesce("earlier_id", "shape.id").alias("id"),
        F.col("shape.place_id").alias("geometry_place"),
    )
    # geometries of rows that no pick can be of stay out of the shuffle
    name = F.col("name")["name"]
    usable = places.filter(name.isNotNull() & (name != "") & F.col("geometry").isNotNull())
    shapes = usable.select(F.col("place_id").alias("geometry_place"), "geometry")
    return merged.join(shapes, "geometry_place").drop("geometry_place")


def merged_members(rows: DataFrame) -> DataFrame:
    """What each survivor gathers from its three groups, one row per entry, in order.

    The long form of the parallel arrays of tags, levels, ids and scores: a lone row appears three times.
    """
    won = survivors(rows).select(
        F.col("place_id").alias("survivor"),
        F.inline(
            F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"key_{k}").alias("key")) for k in range(3)])
        ),
    )
    entries = in_groups(rows).join(won, ["kind", "key"]).select(
        "survivor", "kind", "o", "place_id", "class", "type", "admin_level", "id",
        F.col("imp_order").alias("importance"), "is_node", "digest",
    )
    placed = position_in_group(entries, ["survivor"], [F.col("kind"), F.col("o"), F.col("place_id")])
    return placed.drop("o")
