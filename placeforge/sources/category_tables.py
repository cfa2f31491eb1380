"""Category tables: the built-in ones and loaders for files of the same form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tag keys from most to least significant, their super-category (c civilisation, r road,
# n nature) and, where it differs from the key, their sub-category.
KEYS = [
    ("aerialway", "c"),
    ("aeroway", "c"),
    ("bridge", "c"),
    ("tunnel", "c"),
    ("junction", "r"),
    ("highway", "r"),
    ("railway", "c"),
    ("shop", "c"),
    ("mountain_pass", "c"),
    ("waterway", "c"),
    ("boundary", "c"),
    ("place", "c"),
    ("emergency", "c"),
    ("craft", "c"),
    ("office", "c"),
    ("building", "c"),
    ("amenity", "c"),
    ("leisure", "c"),
    ("tourism", "c"),
    ("man_made", "c"),
    ("military", "c"),
    ("natural", "n"),
    ("landuse", "n"),
    ("historic", "c"),
    ("club", "c", "club_hangout"),
]

# Tags whose category differs from that of their key. Sub-category 1 = the key, 2 = the value.
OVERRIDES = [
    ("place", "city", "c", "2"),
    ("place", "country", "c", "2"),
    ("place", "islet", "n", "island"),
    ("place", "island", "n", "2"),
    ("place", "archipelago", "n", "2"),
    ("place", "peninsula", "n", "2"),
    ("place", "field", "n", "2"),
    ("place", "sea", "n", "2"),
    ("place", "woodland", "n", "2"),
    ("waterway", "stream", "n", "1"),
    ("waterway", "river", "n", "1"),
    ("waterway", "riverbank", "n", "1"),
    ("waterway", "waterfall", "n", "2"),
    ("waterway", "drystream", "n", "1"),
    ("waterway", "wadi", "n", "1"),
    ("waterway", "soakhole", "n", "2"),
    ("waterway", "brook", "n", "1"),
    ("waterway", "lake", "n", "2"),
    ("waterway", "spring", "n", "2"),
    ("waterway", "coastline", "n", "2"),
    ("waterway", "creek", "n", "1"),
    ("amenity", "place_of_worship", "c", "2"),
    ("boundary", "national_park", "n", "2"),
]

# A lookup table is broadcast only up to this many rows; a larger one is joined by shuffle.
BROADCAST_ROWS = 10_000


def _chosen_subcat(key: str, value: str, subcat: str) -> str:
    return {"1": key, "2": value}.get(subcat, subcat)


def _fixed_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    lines = ", ".join(str(r) for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({columns})")


def key_table(spark: SparkSession) -> DataFrame:
    rows = [(n, r[0], r[1], r[2] if len(r) == 3 else r[0]) for n, r in enumerate(KEYS)]
    return _fixed_table(spark, rows, "prio, key, supercat, subcat")


def override_table(spark: SparkSession) -> DataFrame:
    rows = [(k, v, sup, _chosen_subcat(k, v, sub)) for k, v, sup, sub in OVERRIDES]
    return _fixed_table(spark, rows, "key, value, supercat, subcat")


def _blocks(lines: DataFrame) -> DataFrame:
    """Numbered lines (no, value) after the header line, split at single blanks."""
    return lines.filter("no > 0").select("no", F.split("value", " ").alias("b"))


def _checked(condition, message: str, value):
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(no, value) per line of a text file, in file order, from 0."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("no", "value"))


def parse_key_table(lines: DataFrame) -> DataFrame:
    """``key supercat [subcat]`` lines to the ordered key table; the first line is a header."""
    b = F.col("b")
    good = F.size("b").isin(2, 3)
    return _blocks(lines).select(
        (F.col("no") - 1).cast("int").alias("prio"),
        _checked(good, "bad key table line", b[0]).alias("key"),
        b[1].alias("supercat"),
        F.coalesce(F.try_element_at(b, F.lit(3)), b[0]).alias("subcat"),
    )


def parse_override_table(lines: DataFrame) -> DataFrame:
    """``key value supercat subcat`` lines; sub-category 1 = the key, 2 = the value."""
    b = F.col("b")
    sub = F.try_element_at(b, F.lit(4))
    return _blocks(lines).select(
        _checked(F.size("b") == 4, "bad override table line", b[0]).alias("key"),
        F.try_element_at(b, F.lit(2)).alias("value"),
        F.try_element_at(b, F.lit(3)).alias("supercat"),
        F.when(sub == "1", b[0]).when(sub == "2", F.try_element_at(b, F.lit(2))).otherwise(sub).alias("subcat"),
    )


def without_repeats(table: DataFrame, keys: list[str]) -> DataFrame:
    """The table itself; raises when a key stands on several rows, as each would then match."""
    repeated = table.groupBy(*keys).count().filter("count > 1").first()
    if repeated:
        raise ValueError(f"repeated key: {' '.join(str(repeated[k]) for k in keys)}")
    return table


def load_key_table(spark: SparkSession, path: str) -> DataFrame:
    return without_repeats(parse_key_table(numbered_lines(spark, path)), ["key"])


def load_override_table(spark: SparkSession, path: str) -> DataFrame:
    return without_repeats(parse_override_table(numbered_lines(spark, path)), ["key", "value"])


def small_side(table: DataFrame) -> DataFrame:
    """Broadcast hint for a table shown to be small; the plain table otherwise."""
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return F.broadcast(table)
    return table
