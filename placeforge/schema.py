"""Spark schemas of the input and the geometry type."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

# parts -> rings (or lines) -> points, lon/lat in SRID 4326
GEOMETRY = T.StructType(
    [
        T.StructField("gtype", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(POINT)))),
    ]
)

TAGS = T.MapType(T.StringType(), T.StringType())

PLACES = T.StructType(
    [
        T.StructField("place_id", T.LongType()),
        T.StructField("parent_place_id", T.LongType()),
        T.StructField("linked_place_id", T.LongType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("indexed_date", T.TimestampNTZType()),
        T.StructField("geometry_sector", T.IntegerType()),
        T.StructField("rank_address", T.ShortType()),
        T.StructField("rank_search", T.ShortType()),
        T.StructField("partition", T.ShortType()),
        T.StructField("indexed_status", T.ShortType()),
        T.StructField("osm_id", T.LongType()),
        T.StructField("osm_type", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", TAGS),
        T.StructField("admin_level", T.ShortType()),
        T.StructField("address", TAGS),
        T.StructField("extratags", TAGS),
        T.StructField("geometry", GEOMETRY),
        T.StructField("wikipedia", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("housenumber", T.StringType()),
        T.StructField("postcode", T.StringType()),
        T.StructField("centroid", GEOMETRY),
    ]
)
