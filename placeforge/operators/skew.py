"""Joins of rows with facts about their groups, where one group may hold any part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY = 1000  # a group with this part of the rows is looked up by broadcast, so there are at most as many
SPREAD = 100_000


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, unique: Column) -> DataFrame:
    """``rows`` with the other columns of ``groups`` (one row per key), null for rows without a group.

    ``size`` is the number of rows of a group in ``total`` or more rows; ``unique`` differs between the rows of a group.
    Rows of a heavy group meet it by broadcast and are then spread over the join with all other groups.
    """
    facts = [c for c in groups.columns if c not in keys]
    heavy = F.col(size) * HEAVY >= F.lit(total)

    def side(which: Column, prefix: str) -> DataFrame:
        return groups.filter(which).select(*[F.col(c).alias(f"_{prefix}_{c}") for c in groups.columns])

    def same(prefix: str) -> Column:
        met = F.lit(True)
        for k in keys:
            met = met & (F.col(k) == F.col(f"_{prefix}_{k}"))
        return met

    met = rows.join(F.broadcast(side(heavy, "h")), same("h"), "left")
    place = F.when(F.col(f"_h_{size}").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(unique), F.lit(SPREAD)).cast("int") + 1)
    # always 0, but not a constant to the optimizer, which would take it out of the join's keys
    light = side(~heavy, "l").withColumn("_at", F.pmod(F.xxhash64(*[f"_l_{k}" for k in keys]), F.lit(1)).cast("int"))
    met = met.withColumn("_place", place).join(light, same("l") & (F.col("_place") == F.col("_at")), "left")
    return met.select(*rows.columns, *[F.coalesce(f"_h_{c}", f"_l_{c}").alias(c) for c in facts])


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], unique: Column) -> DataFrame:
    """Inner join by ``keys`` of columns that are never null, where a key may hold any part of ``many``.

    Rows of ``many`` under a heavy key are dealt over parts by ``unique``, and its rows in ``few`` go to each part.
    """
    total = max(1, many.count())
    counts = many.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") * HEAVY >= total)  # so at most HEAVY rows
    heavy = counts.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.expr(f"cast(_n * {HEAVY} div {total} as int)").alias("_parts"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_h_{k}"))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = many.join(F.broadcast(heavy), same, "left").select(*many.columns, F.pmod(F.xxhash64(unique), parts).cast("int").alias("_part"))
    copied = few.join(F.broadcast(heavy), same, "left").select(*few.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    return dealt.join(copied, [*keys, "_part"]).drop("_part")
