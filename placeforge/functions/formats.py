"""Text forms: EWKT, GeoJSON and quoted key/value maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeforge.functions.geometry import geometry, point_xy

SRID = 4326


def _position(text: Column) -> Column:
    xy = F.split(F.trim(text), r"\s+")
    return point_xy(xy[0].cast("double"), xy[1].cast("double"))


def _positions(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, r"[()]", ""), ","), _position)


def _groups(text: Column) -> Column:
    """``(a),(b)`` to its bracketed groups."""
    return F.split(text, r"\)\s*,\s*\(")


def from_ewkt(text: Column) -> Column:
    """``SRID=4326;POLYGON((0 0,1 0,1 1,0 0))``, with or without the SRID, to a geometry."""
    body = F.regexp_extract(text, r"(?is)^\s*(?:SRID=\d+;)?\s*([A-Z]+)\s*\((.*)\)\s*$", 2)
    gtype = F.upper(F.regexp_extract(text, r"(?is)^\s*(?:SRID=\d+;)?\s*([A-Z]+)\s*\(", 1))
    one_ring = F.array(F.array(_positions(body)))
    each_point = F.transform(_positions(body), lambda p: F.array(F.array(p)))
    each_line = F.transform(_groups(body), lambda g: F.array(_positions(g)))
    polygon = F.array(F.transform(_groups(body), _positions))
    polygons = F.transform(
        F.split(body, r"\)\s*\)\s*,\s*\(\s*\("), lambda part: F.transform(_groups(part), _positions)
    )
    parts = (
        F.when(gtype.isin("POINT", "LINESTRING"), one_ring)
        .when(gtype == "MULTIPOINT", each_point)
        .when(gtype == "MULTILINESTRING", each_line)
        .when(gtype == "POLYGON", polygon)
        .when(gtype == "MULTIPOLYGON", polygons)
    )
    return F.when(parts.isNotNull(), geometry(gtype, parts))


def _number(value: Column) -> Column:
    """Double as plain decimal text: no exponent, no trailing ``.0``."""
    text = value.cast("string")
    plain = F.regexp_replace(value.cast("decimal(38,18)").cast("string"), r"(\.\d*?)0+$", "$1")
    return F.regexp_replace(F.when(F.contains(text, F.lit("E")), plain).otherwise(text), r"\.0?$", "")


def to_ewkt(geom: Column) -> Column:
    def positions(ring: Column) -> Column:
        return F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", _number(p["x"]), _number(p["y"]))), ",")

    def bracket(text: Column) -> Column:
        return F.concat(F.lit("("), text, F.lit(")"))

    def part(rings: Column) -> Column:
        return F.array_join(F.transform(rings, lambda r: bracket(positions(r))), ",")

    gtype, parts = geom["gtype"], geom["parts"]
    body = (
        F.when(gtype.isin("POINT", "LINESTRING"), positions(parts[0][0]))
        .when(gtype == "MULTIPOINT", F.array_join(F.transform(parts, lambda p: positions(p[0])), ","))
        .when(gtype == "MULTIPOLYGON", F.array_join(F.transform(parts, lambda p: bracket(part(p))), ","))
        .otherwise(F.array_join(F.transform(parts, part), ","))
    )
    return F.concat(F.lit(f"SRID={SRID};"), gtype, bracket(body))


def to_geojson(geom: Column) -> Column:
    def array_of(items: Column) -> Column:
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))

    def position(p: Column) -> Column:
        return F.concat(F.lit("["), _number(p["x"]), F.lit(","), _number(p["y"]), F.lit("]"))

    def line(ring: Column) -> Column:
        return array_of(F.transform(ring, position))

    def polygon(part: Column) -> Column:
        return array_of(F.transform(part, line))

    parts = geom["parts"]
    forms = {
        "Point": position(parts[0][0][0]),
        "MultiPoint": array_of(F.transform(parts, lambda p: position(p[0][0]))),
        "LineString": line(parts[0][0]),
        "MultiLineString": array_of(F.transform(parts, lambda p: line(p[0]))),
        "Polygon": polygon(parts[0]),
        "MultiPolygon": array_of(F.transform(parts, polygon)),
    }
    text = F.lit(None).cast("string")
    for name, coordinates in forms.items():
        whole = F.concat(F.lit(f'{{"type":"{name}","coordinates":'), coordinates, F.lit("}"))
        text = F.when(geom["gtype"] == name.upper(), whole).otherwise(text)
    return text


def from_hstore(text: Column) -> Column:
    """``"k"=>"v", "l"=>NULL`` to a map; backslash escapes are undone."""
    pair = r'"((?:[^"\\]|\\.)*)"\s*=>\s*(?:"(?:[^"\\]|\\.)*"|NULL)'
    value = r'"(?:[^"\\]|\\.)*"\s*=>\s*("(?:[^"\\]|\\.)*"|NULL)'

    def plain(quoted: Column) -> Column:
        return F.regexp_replace(quoted, r"\\(.)", "$1")

    keys = F.transform(F.regexp_extract_all(text, F.lit(pair), F.lit(1)), plain)
    values = F.transform(
        F.regexp_extract_all(text, F.lit(value), F.lit(1)),
        lambda v: F.when(v != "NULL", plain(F.substr(v, F.lit(2), F.length(v) - 2))),
    )
    return F.map_from_arrays(keys, values)
