"""Tables of documents with a number for each row, so that rows are told apart whatever their columns hold."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.session import work_dir

_copies: dict[str, str] = {}  # by application, the last numbered copy


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a table of this application in the shared folder."""
    return f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(docs: DataFrame) -> DataFrame:
    """(_row, _doc): a written copy with a number for each row; ``_doc`` holds all columns, whatever their names.

    For stages of a pipeline, each of which is written before the next begins: a copy lasts until the next is made.
    """
    spark = docs.sparkSession
    app, path = spark.sparkContext.applicationId, new_folder(spark, "numbered")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_doc"))
    rows.write.option("compression", "zstd").parquet(path)
    if app in _copies:
        remove(spark, _copies[app])
    _copies[app] = path
    return spark.read.schema(rows.schema).parquet(path)


def by_row(rows: DataFrame) -> DataFrame:
    """(doc_id, text) of a numbered table with the row's number as the id."""
    return rows.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text"))


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The documents of a numbered table, but those whose number is in ``dropped``, in their own columns."""
    gone = dropped.select(F.col(key).alias("_row")).distinct()
    return rows.join(gone, "_row", "left_anti").select("_doc.*")
