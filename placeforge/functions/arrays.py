"""Columns over arrays inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_of(values: Column, sep: str = ",") -> Column:
    """Array to text; NULL entries are skipped."""
    return F.array_join(values, sep)


def fill_nulls(values: Column, filler) -> Column:
    """Array with every NULL entry replaced."""
    return F.transform(values, lambda v: F.coalesce(v, F.lit(filler)))


def at_position_of(values: Column, keys: Column, key: Column) -> Column:
    """``values[i]`` with i the first position of ``key`` in ``keys``; NULL when absent."""
    return F.try_element_at(values, F.nullif(F.array_position(keys, key), F.lit(0)).cast("int"))


def with_unique_id(values: Column, ids: Column) -> Column:
    """The first value of every distinct id, in order of first position."""
    pairs = F.arrays_zip(values.alias("v"), ids.alias("i"))
    firsts = F.filter(
        F.transform(pairs, lambda p, n: F.struct(p["v"].alias("v"), p["i"].alias("i"), n.alias("n"))),
        lambda p: F.array_position(ids, p["i"]) == p["n"] + 1,
    )
    return F.transform(firsts, lambda p: p["v"])
