"""Tags to categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.sources.category_tables import key_table, override_table, small_side, without_repeats


def _lookup(table: DataFrame | None, built_in, spark, keys: list[str], *columns: Column) -> DataFrame:
    """The built-in table (fixed, 25 rows at most) is broadcast; one from the user after checks of size and keys."""
    if table is None:
        return F.broadcast(built_in(spark).select(*columns))
    return small_side(without_repeats(table, keys).select(*columns))


NO_PRIO = 2**31 - 1  # of a class the key table lacks
NO_LEVEL = -1  # of a row without an admin level

# Sub-category of administrative boundaries by admin level; any other level is a border.
ADMIN_SUBCATS = {
    1: "continent",
    2: "country",
    3: "state",
    4: "state",
    5: "state district",
    6: "county",
    7: "county",
    8: "city",
    9: "city district",
}


def admin_subcat(level: Column) -> Column:
    found = F.lit("border")
    for number, subcat in ADMIN_SUBCATS.items():
        found = F.when(level == number, subcat).otherwise(found)
    return found


def with_key_prio(rows: DataFrame, keys: DataFrame | None = None, class_col: str = "class") -> DataFrame:
    """Adds ``prio``, the place of the row's class in the key table."""
    prios = _lookup(
        keys, key_table, rows.sparkSession, ["key"], F.col("key").alias(class_col), F.col("prio").alias("_prio")
    )
    joined = rows.join(prios, class_col, "left")
    return joined.withColumn("prio", F.coalesce("_prio", F.lit(NO_PRIO))).drop("_prio")


def with_category(
    rows: DataFrame,
    keys: DataFrame | None = None,
    overrides: DataFrame | None = None,
    on_unknown: str = "fail",
) -> DataFrame:
    """Adds ``supercat, subcat`` for the tag in ``class, type, admin_level``.

    Administrative boundaries go by level, then the override table decides, then the key table.
    A key that the key table lacks fails the job, or is dropped with ``on_unknown='drop'``.
    """
    spark = rows.sparkSession
    by_key = _lookup(
        keys, key_table, spark, ["key"],
        F.col("key").alias("class"), F.col("supercat").alias("_ks"), F.col("subcat").alias("_kc"),
    )
    by_tag = _lookup(
        overrides, override_table, spark, ["key", "value"],
        F.col("key").alias("class"), F.col("value").alias("type"),
        F.col("supercat").alias("_os"), F.col("subcat").alias("_oc"),
    )
    joined = rows.join(by_tag, ["class", "type"], "left").join(by_key, "class", "left")
    admin = (F.col("class") == "boundary") & (F.col("type") == "administrative")
    known = admin | F.col("_ks").isNotNull()
    if on_unknown == "drop":
        joined = joined.filter(known)
    elif on_unknown == "fail":
        missing = F.raise_error(F.concat(F.lit("not in the key table: "), F.coalesce("class", F.lit("NULL"))))
        # as a filter the test also runs where no column of the result is read
        joined = joined.filter(F.when(known, F.lit(True)).otherwise(missing.cast("boolean")))
    else:
        raise ValueError(f"on_unknown: {on_unknown}")
    supercat = F.when(admin, "c").otherwise(F.coalesce("_os", "_ks"))
    subcat = F.when(admin, admin_subcat(F.col("admin_level"))).otherwise(
        F.replace(F.coalesce("_oc", "_kc"), F.lit("_"), F.lit(" "))
    )
    return joined.select(*rows.columns, supercat.alias("supercat"), subcat.alias("subcat"))


def pick_tag(tags: Column) -> Column:
    """The tag of an array of ``struct<prio, class, type, admin_level>`` whose key ranks first.

    Of several tags with that key the first in the array is taken.
    """
    placed = F.transform(
        tags,
        lambda t, n: F.struct(
            t["prio"].alias("prio"), n.alias("n"), t["class"].alias("class"), t["type"].alias("type"),
            t["admin_level"].alias("admin_level"),
        ),
    )
    best = F.array_min(placed)
    return F.struct(*[best[c].alias(c) for c in ("prio", "class", "type", "admin_level")])
