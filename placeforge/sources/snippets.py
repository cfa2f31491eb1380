"""Text between marker lines, and the tag keys compared in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = "***START***", "***STOP***"
# Fixed value: a comparison of the tag key with a literal. The match is greedy, as the last quote on a
# line ends it.
KEY_COMPARISON = r'strcmp\(k, "(.*)"\)'
EXTRA_KEYS = ["building"]


def between_markers(texts: DataFrame, column: str = "value") -> DataFrame:
    """Lines of each whole text from the start marker up to the stop marker; none without a start."""
    lines = F.split(column, r"\r?\n")
    tagged = texts.select(lines.alias("lines"))
    stop = F.array_position("lines", STOP)
    before_stop = F.when(stop > 0, F.slice("lines", F.lit(1), (stop - 1).cast("int"))).otherwise(F.col("lines"))
    cut = tagged.select(before_stop.alias("lines"))
    start = F.array_position("lines", START).cast("int")
    return cut.filter(start > 0).select(F.explode(F.slice("lines", start, F.size("lines"))).alias("line"))


def interesting_keys(lines: DataFrame, column: str = "line") -> DataFrame:
    """Distinct keys compared in the lines, and the extra ones, sorted."""
    key = F.regexp_extract(column, KEY_COMPARISON, 1)
    found = lines.filter(F.col(column).rlike(KEY_COMPARISON)).select(key.alias("key"))
    extra = lines.sparkSession.createDataFrame([(k,) for k in EXTRA_KEYS], "key string")
    return found.union(extra).distinct().orderBy("key")
