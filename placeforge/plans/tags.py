"""Raw OSM tags of an object to the place rows they make.

All rules are column expressions on one object's tags, so the job is one narrow pass over the objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ADMIN_LEVEL = 15

# Which keys mean what.
EXTRA_NAME_KEYS = ["name:prefix", "name:suffix", "name:botanical"]
REF_KEYS = ["ref", "int_ref", "nat_ref", "reg_ref", "loc_ref", "old_ref", "iata", "icao", "operator", "pcode"]
NAME_KEYS = [
    "name", "int_name", "nat_name", "reg_name", "loc_name", "old_name", "alt_name", "official_name",
    "place_name", "short_name",
]
# Keys that make a place, with the values that do not.
PLACE_KEYS = {
    "emergency": ["fire_hydrant", "yes", "no"],
    "tourism": ["no", "yes"],
    "historic": ["no", "yes"],
    "military": ["no", "yes"],
    "natural": ["no", "yes", "coastline"],
    "highway": ["no", "turning_circle", "mini_roundabout", "noexit", "crossing"],
    "railway": ["level_crossing", "no"],
    "man_made": ["survey_point", "cutline"],
    "aerialway": ["pylon", "no"],
    "boundary": [],
    "aeroway": ["no"],
    "amenity": ["no"],
    "club": ["no"],
    "bridge": ["no"],
    "craft": ["no"],
    "leisure": ["no"],
    "office": ["no"],
    "shop": ["no"],
    "tunnel": ["no"],
    "mountain_pass": ["no"],
    "waterway": ["riverbank"],
}
POSTCODE_KEYS = ["postal_code", "postcode", "addr:postcode", "tiger:zip_left", "tiger:zip_right"]
COUNTRY_KEYS = [
    "country_code", "ISO3166-1", "is_in:country_code", "is_in:country", "addr:country", "addr:country_code",
]
HOUSE_KEYS = ["addr:housenumber", "addr:conscriptionnumber", "addr:streetnumber"]
# Keys kept as further details.
DETAIL_KEYS = [
    "tracktype", "traffic_calming", "service", "cuisine", "capital", "dispensing", "religion",
    "denomination", "sport", "internet_access", "lanes", "surface", "smoothness", "width", "est_width",
    "incline", "opening_hours", "collection_times", "service_times", "disused", "wheelchair", "sac_scale",
    "trail_visibility", "mtb:scale", "mtb:description", "wood", "drive_through", "drive_in", "access",
    "vehicle", "bicyle", "foot", "goods", "hgv", "motor_vehicle", "motor_car", "oneway", "date_on",
    "date_off", "day_on", "day_off", "hour_on", "hour_off", "maxweight", "maxheight", "maxspeed", "fee",
    "toll", "charge", "population", "description", "image", "attribution", "fax", "email", "url",
    "website", "phone", "real_ale", "smoking", "food", "camera", "brewery", "locality", "wikipedia",
]
DETAIL_PREFIXES = ["access:", "contact:", "drink:", "toll:", "wikipedia:"]


#: what a whole key says; where a key is in several lists the first counts
_BY_KEY = {
    **{k: "extra" for k in DETAIL_KEYS},
    **{k: "address" for k in ("is_in", "tiger:county")},
    **{k: "country" for k in COUNTRY_KEYS},
    **{k: "postcode" for k in POSTCODE_KEYS},
    **{k: f"main_{k}" for k in ("place", "junction")},
    **{k: "place" if excluded else "any_place" for k, excluded in PLACE_KEYS.items()},
    **{k: k for k in ("landuse", "admin_level", "building")},
    "addr:housename": "housename",
    **{k: "name" for k in (*NAME_KEYS, "brand")},
    **{k: "ref" for k in REF_KEYS},
    **{k: "extra" for k in EXTRA_NAME_KEYS},
}
#: what the part of a key up to its first colon says; all prefixes end there
_BY_PREFIX = {
    **{p.removesuffix(":"): "extra" for p in DETAIL_PREFIXES},
    "is_in": "is_in",
    "addr": "addr",
    **{k: "name" for k in NAME_KEYS},
    "pcode": "ref",
}
_NO_PLACE = [f"{k}={v}" for k, excluded in PLACE_KEYS.items() for v in excluded]


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _role(k: Column, v: Column, sidewalk: Column) -> Column:
    """What a tag is for: by the end of its key, by the whole key, then by its prefix, whatever its value."""
    footway = sidewalk & (k == "highway") & (v == "footway")
    whole = F.try_element_at(_lookup(_BY_KEY), k)
    prefix = F.when(F.startswith(k, F.lit("alt_name_")), "name").when(
        F.contains(k, F.lit(":")), F.try_element_at(_lookup(_BY_PREFIX), F.substring_index(k, ":", 1))
    )
    found = F.when(F.endswith(k, F.lit("source")), "none").when(F.endswith(k, F.lit("wikidata")), "extra").otherwise(F.coalesce(whole, prefix, F.lit("none")))
    # the found rule is bound once and then tried on the value
    tried = F.transform(
        F.array(found),
        lambda r: F.when(r == "place", F.when(~F.concat(k, F.lit("="), v).isin(*_NO_PLACE) & ~footway, "place").otherwise("none"))
        .when(r == "any_place", "place")
        .when(r == "country", F.when(F.octet_length(v) == 2, "country").otherwise("none"))
        .when((r == "landuse") & (v == "cemetry"), "place")
        .otherwise(r),
    )
    return F.get(tried, F.lit(0))


def _with_role(roles: list[str]) -> Column:
    return F.filter("roled", lambda t: t["role"].isin(*roles))


def _tag(k, v) -> Column:
    return F.struct(F.lit(k).alias("k") if isinstance(k, str) else k.alias("k"), (F.lit(v) if isinstance(v, str) else v).alias("v"))


def _any(roles: list[str]) -> Column:
    return F.exists("roled", lambda t: t["role"].isin(*roles))


def _bare(tags: Column) -> Column:
    return F.transform(tags, lambda t: _tag(t["k"], t["v"]))


def _last(role: str) -> Column:
    return F.try_element_at(_with_role([role]), F.lit(-1))


def _list_if(condition: Column, tag: Column) -> Column:
    return F.when(condition, F.array(tag)).otherwise(F.array().cast("array<struct<k:string,v:string>>"))


def _address() -> Column:
    """Address parts; of several tags for one part the first counts."""
    prefix = {"addr": 6, "is_in": 7}
    named = F.transform(
        _with_role(["postcode", "country", "addr", "is_in", "address"]),
        lambda t: _tag(
            F.when(t["role"].isin("postcode", "country"), t["role"])
            .when(t["role"] == "addr", F.substr(t["k"], F.lit(prefix["addr"])))
            .when(t["role"] == "is_in", F.substr(t["k"], F.lit(prefix["is_in"])))
            .otherwise(t["k"]),
            t["v"],
        ),
    )
    firsts = F.filter("parts", lambda t, n: F.array_position(F.col("parts")["k"], t["k"]) == n + 1)
    return named, F.map_from_entries(firsts)


def _admin_level() -> Column:
    """Leading integer of the last admin_level tag; anything outside 1..15 is 15."""
    text = _last("admin_level")["v"]
    number = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("int")
    return F.when(number.between(1, MAX_ADMIN_LEVEL), number).otherwise(F.lit(MAX_ADMIN_LEVEL))


def classify_tags(objects: DataFrame, unnamed_drop_keys: list[str] | None = None) -> DataFrame:
    """Objects ``osm_type, osm_id, tags array<struct<k, v>>`` with what their tags say.

    Adds ``places`` and ``names``, ``extratags`` (arrays of k, v), ``address`` (map) and ``admin_level``.
    ``unnamed_drop_keys`` are place keys an object without a name does not get.
    """
    sidewalk = F.exists("tags", lambda t: (t["k"] == "footway") & (t["v"] == "sidewalk"))
    rows = objects.withColumn("sidewalk", sidewalk)
    rows = rows.withColumn(
        "roled",
        F.transform(
            "tags",
            lambda t: F.struct(t["k"].alias("k"), t["v"].alias("v"), _role(t["k"], t["v"], F.col("sidewalk")).alias("role")),
        ),
    )
    named_parts, address = _address()
    rows = rows.withColumn("parts", named_parts).withColumn("address", address)
    rows = rows.select(
        *objects.columns, "roled", "address",
        _bare(_with_role(["ref", "name", "housename"])).alias("names"),
        _any(["name"]).alias("named"),
        (_any(["housename"]) | F.exists("tags", lambda t: t["k"].isin(*HOUSE_KEYS))).alias("house"),
        F.exists("roled", lambda t: (t["role"] == "addr") & (t["k"] == "addr:interpolation")).alias("interpolated"),
        F.exists("tags", lambda t: (t["k"] == "boundary") & (t["v"] == "administrative")).alias("admin"),
        _last("main_place").alias("place"),
        _admin_level().alias("admin_level"),
    )
    dropped = unnamed_drop_keys or []
    own = _with_role(["place"])
    if dropped:
        own = F.filter(own, lambda t: F.col("named") | ~t["k"].isin(*dropped))
    has_place = F.col("place").isNotNull()
    as_extra = has_place & (
        F.col("interpolated") | (F.col("admin") & ~F.col("place.v").isin("island", "islet"))
    )
    place_tag = _tag(F.col("place.k"), F.col("place.v"))
    first = rows.withColumn(
        "places",
        F.concat(
            _bare(own),
            _list_if(F.col("interpolated"), _tag("place", "houses")),
            _list_if(has_place & ~as_extra, place_tag),
        ),
    ).withColumn("extratags", F.concat(_bare(_with_role(["extra"])), _list_if(as_extra, place_tag)))
    junction, landuse = _last("main_junction"), _last("landuse")
    fallback = F.coalesce(junction, landuse)
    second = first.withColumn(
        "places",
        F.when(
            F.col("named") & (F.size("places") == 0) & fallback.isNotNull(),
            F.array(_tag(fallback["k"], fallback["v"])),
        ).otherwise(F.col("places")),
    )
    postcode = F.map_contains_key("address", F.lit("postcode"))
    last = (
        F.when(
            _any(["building"]) & ((F.size("names") > 0) | F.col("house") | postcode), F.array(_tag("building", "yes"))
        )
        .when(F.col("house"), F.array(_tag("place", "house")))
        .when(postcode, F.array(_tag("place", "postcode")))
        .otherwise(F.col("places"))
    )
    third = second.withColumn("places", F.when(F.size("places") == 0, last).otherwise(F.col("places")))
    return third.select(*objects.columns, "places", "names", "extratags", "address", "admin_level")


def place_rows(objects: DataFrame, unnamed_drop_keys: list[str] | None = None) -> DataFrame:
    """One row per place of an object: its tag as ``class, type`` with names, details, address and level."""
    found = classify_tags(objects, unnamed_drop_keys)
    rest = ["names", "extratags", "address", "admin_level"]
    # a plain explode would repeat the whole rule set in a test of the array's size
    rows = found.select("osm_type", "osm_id", F.explode_outer("places").alias("p"), *rest).filter("p is not null")
    return rows.select("osm_type", "osm_id", F.col("p.k").alias("class"), F.col("p.v").alias("type"), *rest)
