"""Joins of rows with their groups where a group may hold any part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY = 1000  # a group with this part of the rows is looked up by broadcast, so there are at most as many of them


def _sides(groups: DataFrame, key: str, size: str, total: int) -> tuple[DataFrame, DataFrame]:
    heavy = F.col(size) * HEAVY >= total
    facts = F.struct(*[c for c in groups.columns if c != key])
    return (
        groups.filter(heavy).select(F.col(key).alias("_heavy"), facts.alias("_h")),
        groups.filter(~heavy).select(F.col(key).alias("_light"), facts.alias("_l")),
    )


def with_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, unique: Column) -> DataFrame:
    """``rows`` with the struct ``group`` of their group's columns, null without one.

    ``key`` is a string or binary column of both; ``groups`` is a written table with one row per key, and ``size`` is its
    column with the group's number of rows out of ``total``. ``unique`` differs from row to row. Large groups are
    broadcast, at most ``HEAVY``; rows that have met one are spread over the join with all other groups.
    """
    heavy, light = _sides(groups, key, size, total)
    met = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left")
    own = F.col(key).cast("binary")
    spread = F.concat(F.lit("met "), unique.cast("string")).cast("binary")
    met = met.withColumn("_key", F.when(F.col("_h").isNull(), own).otherwise(spread))
    met = met.join(light.withColumn("_light", F.col("_light").cast("binary")), F.col("_key") == F.col("_light"), "left")
    return met.select(*rows.columns, F.coalesce("_h", "_l").alias("group"))


def inner_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Rows that have a group, with the struct ``group``; see ``with_groups``. Reads ``rows`` twice."""
    heavy, light = _sides(groups, key, size, total)
    of_heavy = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy")).select(*rows.columns, F.col("_h").alias("group"))
    rest = rows.join(F.broadcast(heavy.select("_heavy")), F.col(key) == F.col("_heavy"), "left_anti")
    return of_heavy.union(rest.join(light, F.col(key) == F.col("_light")).select(*rows.columns, F.col("_l").alias("group")))
