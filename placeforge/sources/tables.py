"""Reading places and writing objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.schema import PLACES
from placeforge.session import durable, forget

FETCH_ROWS = 1000
MANIFEST = "_files"  # folder within a stored table; Spark passes over it when it reads the table


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLACES).parquet(path)


def read_places_jdbc(spark: SparkSession, url: str, table: str, bounds: tuple[int, int], tasks: int, **options) -> DataFrame:
    """Places of a database, read by ranges of place id, fetched in steps of ``FETCH_ROWS``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=FETCH_ROWS, **options)
    return reader.options(
        partitionColumn="place_id", lowerBound=bounds[0], upperBound=bounds[1], numPartitions=tasks
    ).load()


def check_elems(elems: DataFrame) -> None:
    """No column empty on page 0, and popindex exactly 1..n there; no page twice, none without its object. Raises otherwise."""
    columns = ["popindex", "page", "name", "supercat", "subcat", "geometry", "area", "osm_ids"]
    objects = elems.filter("page = 0 or page is null")
    empty = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns]
    row = objects.agg(*empty, F.count("*").alias("rows"), F.min("popindex").alias("lo"), F.max("popindex").alias("hi")).first()
    bad = [c for c in columns if row[c]]
    if bad:
        raise ValueError(f"elems with empty columns: {bad}")
    n = row["rows"]
    pages = elems.groupBy("popindex").agg(
        F.count("*").alias("rows"), F.count_distinct("page").alias("pages"), F.sum((F.col("page") == 0).cast("long")).alias("first")
    )
    wrong = pages.filter("popindex is null or rows <> pages or first <> 1")
    # n different whole numbers from 1 to n
    if (n and (row["lo"], row["hi"]) != (1, n)) or not wrong.isEmpty():
        raise ValueError("popindex is not 1..n")


def write_elems(elems: DataFrame, path: str, by: str = "area") -> None:
    """Replaces the table of objects, laid out for the query that serves it.

    ``by='area'`` keeps neighbours together, so files are skipped by their box columns;
    ``by='popindex'`` keeps ranks together, for paging. The manifest has a row for each file: its box, ranks and pages.
    """
    elems = durable(elems, "elems")  # the ranges are found by a pass of their own
    if by == "area":
        # interleaved bits of the box corner on a grid of 2^16 x 2^16: near in space, near in the file
        def cell(value, low: float, span: float):
            return F.floor((value - low) / span * 65535).cast("int")

        x, y = cell(F.col("minx"), -180.0, 360.0), cell(F.col("miny"), -90.0, 180.0)
        curve = F.lit(0).cast("long")
        for bit in range(16):
            curve = curve + (F.shiftright(x, bit).bitwiseAND(1).cast("long") * (1 << (2 * bit)))
            curve = curve + (F.shiftright(y, bit).bitwiseAND(1).cast("long") * (1 << (2 * bit + 1)))
        keyed = elems.withColumn("_curve", curve)
        laid = keyed.repartitionByRange("_curve", "popindex", "page").sortWithinPartitions("_curve", "popindex", "page").drop("_curve")
    elif by == "popindex":
        laid = elems.repartitionByRange("popindex", "page").sortWithinPartitions("popindex", "page")
    else:
        raise ValueError(f"by: {by}")
    laid.write.mode("overwrite").parquet(path)
    stored = elems.sparkSession.read.parquet(path)
    box = [F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")]
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *box, F.min("popindex").alias("first"), F.max("popindex").alias("last"), F.max("page").alias("last_page")
    )
    files.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    forget(elems)
