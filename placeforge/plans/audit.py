"""Reports on places and objects: duplicates, rejected pages, wide rows, large geometries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions.geometry import num_points
from placeforge.functions.scoring import browse_score
from placeforge.functions.text import test_wikipedia, to_web
from placeforge.operators.ordered import list_pages, lists_on_rows, position_in_group, running_lists
from placeforge.operators.skew import with_groups
from placeforge.session import durable


def place_name() -> Column:
    return F.col("name")["name"]


def score() -> Column:
    return browse_score(F.col("importance"), F.col("rank_search"), fill=False)


def in_repeated_groups(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows whose group has more than one row, with the group size ``n``; rows with a null key have no group.

    ``order`` tells the rows of a group apart. Sizes come from partial counts; the rows of a large group are not
    brought together.
    """
    repeated = durable(repeated_keys(rows, keys), "repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    return with_groups(rows, repeated, keys, "n", total, F.struct(*order)).filter("n is not null")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on more than one row, and how many."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicates_report(rows: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """One row per repeated key and page of its list: ``keys, page, items`` (see ``list_pages``)."""
    return list_pages(in_repeated_groups(rows, keys, order), keys, order, values)


def page_texts(report: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """A report's pages with the number of entries and each value's entries as one text, missing ones as ``-``."""

    def listed(value: str) -> Column:
        texts = F.transform("items", lambda i: F.coalesce(i[value].cast("string"), F.lit("-")))
        return F.array_join(texts, ", ").alias(value + "s")

    return report.select(*keys, "page", F.size("items").alias("entries"), *[listed(v) for v in values])


def _described(places: DataFrame) -> DataFrame:
    return places.select(
        "place_id", "osm_type", "osm_id", "importance", "rank_search", "wikipedia",
        F.col("extratags")["wikidata"].alias("wikidata"),
        place_name().alias("name"), score().alias("score"),
        to_web(F.col("osm_type"), F.col("osm_id")).alias("web"),
    )


def same_object_report(places: DataFrame) -> DataFrame:
    """Names and scores of the rows of each OSM object with several."""
    return duplicates_report(_described(places), ["osm_type", "osm_id"], [F.col("place_id")], ["name", "score"])


def same_wikipedia_report(places: DataFrame) -> DataFrame:
    """Names and links of the rows of each wikipedia page with several."""
    rows = _described(places).filter(F.col("wikipedia") != "")
    return duplicates_report(rows, ["wikipedia"], [F.col("place_id")], ["name", "web"])


def same_wikidata_report(places: DataFrame) -> DataFrame:
    """Names, importances and links of the rows of each wikidata item with several."""
    rows = _described(places).filter(F.col("wikidata") != "")
    return duplicates_report(rows, ["wikidata"], [F.col("place_id")], ["name", "importance", "web"])


def same_name_report(elems: DataFrame) -> DataFrame:
    """Ranks, categories and all ids of objects that share a name; an object of several pages has an entry for each."""
    repeated = durable(repeated_keys(elems.filter("page = 0"), ["name"]), "repeated")
    total = repeated.agg(F.sum("n")).first()[0] or 0
    rows = with_groups(elems, repeated, ["name"], "n", total, F.struct("popindex", "page")).filter("n is not null")
    return list_pages(rows, ["name"], [F.col("popindex"), F.col("page")], ["popindex", "page", "supercat", "subcat", "osm_ids"])


def ranks_by_name(elems: DataFrame) -> DataFrame:
    """Every object with the best rank of its name and its place among the objects of that name."""
    objects = elems.filter("page = 0")
    best = durable(objects.groupBy("name").agg(F.min("popindex").alias("best"), F.count("*").alias("n")), "best")
    placed = position_in_group(objects.select("name", "popindex"), ["name"], [F.col("popindex")], "nth")
    total = best.agg(F.sum("n")).first()[0] or 0
    return with_groups(placed, best, ["name"], "n", total, F.col("popindex")).select(
        F.left("name", F.lit(30)).alias("name"), "popindex", "nth", "best", (F.col("popindex") == F.col("best")).alias("is_best")
    )


def group_positions(places: DataFrame) -> DataFrame:
    """Places with their position by score, lowest first, among the rows of each of their three groups."""
    own = F.col("place_id").cast("string")
    rows = _described(places).select(
        "place_id", "name", "osm_type", "osm_id", "score",
        F.coalesce("wikipedia", own).alias("page_key"), F.coalesce("wikidata", own).alias("item_key"),
    )
    order = [F.asc_nulls_last("score"), F.col("place_id")]
    placed = position_in_group(rows, ["osm_type", "osm_id"], order, "object_index")
    placed = position_in_group(placed, ["page_key"], order, "wikipedia_index")
    placed = position_in_group(placed, ["item_key"], order, "wikidata_index")
    return placed.select("place_id", "name", "object_index", "wikipedia_index", "wikidata_index")


def first_of_object(places: DataFrame) -> DataFrame:
    """The least important row of each OSM object (rows without importance last), if named, by score."""
    firsts = _described(places).groupBy("osm_type", "osm_id").agg(
        F.min_by(
            F.struct("place_id", "name", "rank_search", "score", "web"),
            F.struct(F.col("importance").isNull(), "importance", "place_id"),
        ).alias("f")
    )
    return firsts.filter(F.col("f.name") != "").select(
        F.left("f.name", F.lit(30)).alias("name"), "f.place_id", "f.rank_search", "f.web", "f.score"
    ).orderBy(F.desc_nulls_first("score"), "place_id")


def classes_so_far(places: DataFrame) -> DataFrame:
    """The running list of classes and types of an OSM object, up to its lowest-scored row.

    In pages of the list, as one object may have any number of rows.
    """
    rows = places.select("osm_type", "osm_id", "place_id", "class", "type", place_name().alias("name"), score().alias("score"))
    firsts = rows.groupBy("osm_type", "osm_id").agg(
        F.min(F.struct(F.col("score").isNull().alias("none"), "score", "place_id", "name")).alias("f"), F.count("*").alias("n")
    ).filter(F.col("f.name") != "")
    ends = durable(firsts.select("osm_type", "osm_id", F.col("f.place_id").alias("last"), F.col("f.name").alias("name"), "n"), "ends")
    total = ends.agg(F.sum("n")).first()[0] or 0
    upto = with_groups(rows.drop("name"), ends, ["osm_type", "osm_id"], "n", total, F.col("place_id"))
    upto = upto.filter(F.col("place_id") <= F.col("last")).drop("n")
    listed = list_pages(upto, ["osm_type", "osm_id", "name"], [F.col("place_id")], ["class", "type"])
    return listed.select(
        "osm_type", "osm_id", "name", "page",
        F.array_join(F.col("items")["class"], "_:_").alias("classes"),
        F.array_join(F.col("items")["type"], "_:_").alias("types"),
    )


def object_lists(places: DataFrame) -> DataFrame:
    """Every place with the names, classes and types of its OSM object's rows: those up to it, and all.

    A list is that of the row's page (``page``, of at most ``ordered.PAGE`` rows); earlier and later pages are on the rows
    of these. ``by_score`` is the row's place by score, lowest first; rows come by falling score.
    """
    keys, values = ["osm_type", "osm_id"], ["name", "class", "type"]
    rows = places.select(
        *keys, "place_id", place_name().alias("name"), "class", "type", "admin_level", F.col("geometry.gtype").alias("gtype"), score().alias("score")
    )
    ranked = position_in_group(rows, keys, [F.col("score").asc_nulls_last(), F.col("place_id")], "by_score")
    listed = lists_on_rows(*running_lists(ranked, keys, [F.col("place_id")], values), keys)
    so_far = lambda v: F.array_join(F.slice(F.col("items")[v], F.lit(1), F.col("length")), "_:_")
    return listed.select(
        *keys, "place_id", "name", "admin_level", "gtype", "score", "by_score", "pos", "page",
        so_far("class").alias("classes_so_far"), so_far("type").alias("types_so_far"),
        *[F.array_join(F.col("items")[v], "_:_").alias(f"all_{n}") for v, n in zip(values, ("names", "classes", "types"))],
    ).orderBy(F.desc_nulls_first("score"), "place_id")


def object_entries(places: DataFrame) -> DataFrame:
    """The rows of every OSM object in order: osm_type, osm_id, pos, name, class, type, admin_level.

    The long form of lists over an object's rows: its whole lists are all its entries, and the running lists of a row are
    the entries up to the row's own.
    """
    rows = places.select("osm_type", "osm_id", "place_id", place_name().alias("name"), "class", "type", "admin_level")
    return position_in_group(rows, ["osm_type", "osm_id"], [F.col("place_id")])


def names_summary(places: DataFrame) -> DataFrame:
    """Per name: its rows, those with a page, the best importance among these and the type that it has."""
    paged = F.col("wikipedia").isNotNull()
    best = F.max(F.when(paged, F.col("importance")))
    return places.groupBy(place_name().alias("name")).agg(
        F.count("*").alias("n"), F.count_if(paged).alias("with_page"), best.alias("best"), F.upper(F.typeof(best)).alias("kind")
    )


def rejected_wikipedia(places: DataFrame) -> DataFrame:
    """Places whose wikipedia page does not hold their name, though they have an importance."""
    rows = places.filter(F.col("wikipedia").isNotNull() & F.col("importance").isNotNull()).filter(
        test_wikipedia(place_name(), F.col("wikipedia")).isNull()
    )
    return rows.select("place_id", place_name().alias("name"), "wikipedia", "importance").orderBy(
        F.desc_nulls_first("importance"), "place_id"
    )


def widest_rows(table: DataFrame, label: Column, count: int = 10) -> DataFrame:
    """The rows with the longest text form."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return table.select(label.alias("label"), size.alias("bytes")).orderBy(F.desc("bytes"), "label").limit(count)


def count_larger_than(places: DataFrame, n: int) -> DataFrame:
    """Number of geometries with more than ``n`` points."""
    return places.filter(num_points(F.col("geometry")) > n).agg(F.count("*").alias("n"))


def most_points(places: DataFrame, gtype: str = "LINESTRING") -> DataFrame:
    """The geometry of a kind with the most points."""
    rows = places.filter(F.col("geometry.gtype") == gtype).select("place_id", num_points(F.col("geometry")).alias("points"))
    return rows.orderBy(F.desc("points"), "place_id").limit(1)


def top_name(places: DataFrame) -> DataFrame:
    """The name whose best row scores highest, and its number of rows."""
    best = F.coalesce(F.max("importance"), F.lit(0.75) - F.min("rank_search").cast("double") / F.lit(40.0))
    groups = places.groupBy(place_name().alias("name")).agg(F.count("*").alias("n"), best.alias("best"))
    return groups.orderBy(F.desc_nulls_first("best"), "name").limit(1)


def browse(places: DataFrame) -> DataFrame:
    """Listing of places by score: id, short name, tag, kind of geometry, references and link."""
    return places.select(
        browse_score(F.col("importance"), F.col("rank_search")).alias("importance"),
        F.concat("osm_type", F.col("osm_id").cast("string")).alias("osm_id"),
        F.left(place_name(), F.lit(30)).alias("name"),
        "class", "type",
        F.col("geometry.gtype").alias("geom"),
        F.col("extratags")["wikidata"].alias("wikidata"),
        "wikipedia",
        to_web(F.col("osm_type"), F.col("osm_id")).alias("web"),
        "place_id",
    ).orderBy(F.desc_nulls_first("importance"), "place_id")


def place_details(places: DataFrame, name: str, place_ids: list[int] | None = None) -> DataFrame:
    """All columns but the geometry of the places of a name, or of given ids."""
    chosen = place_name() == name if place_ids is None else F.col("place_id").isin(*place_ids)
    short = F.left(place_name(), F.lit(20)).alias("name")
    rest = [c for c in places.columns if c not in ("name", "geometry")]
    return places.filter(chosen).select(short, *rest)


def rows_of_object(places: DataFrame, osm_type: str, osm_id: int) -> DataFrame:
    """Tag, short name, level and link of each row of one OSM object."""
    rows = places.filter((F.col("osm_type") == osm_type) & (F.col("osm_id") == osm_id))
    return rows.select(
        "class", "type", F.left(place_name(), F.lit(40)).alias("name"), "admin_level",
        to_web(F.col("osm_type"), F.col("osm_id")).alias("web"),
    )


def names_matching(places: DataFrame, pattern: str) -> DataFrame:
    """Places whose name matches a regular expression."""
    return places.filter(place_name().rlike(pattern)).select("place_id", place_name().alias("name"))


def reference_systems(table: DataFrame, pattern: str) -> DataFrame:
    """Rows of a table of spatial reference systems whose definition ``srtext`` matches."""
    return table.filter(F.col("srtext").rlike(pattern))
