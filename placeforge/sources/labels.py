"""Label lines ``class type 'Label'`` and the audit of labels that do not restate their tag value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FORM = r"^(\S+) (\S+) '(.*)'$"


def parse_labels(lines: DataFrame, column: str = "value") -> DataFrame:
    line = F.col(column)
    return lines.filter(line.rlike(_FORM)).select(
        F.regexp_extract(line, _FORM, 1).alias("class"),
        F.regexp_extract(line, _FORM, 2).alias("type"),
        F.regexp_extract(line, _FORM, 3).alias("label"),
    )


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    return parse_labels(spark.read.text(path))


def default_label(type_: Column) -> Column:
    """The label most tag values have: their words, capitalised."""
    return F.initcap(F.replace(type_, F.lit("_"), F.lit(" ")))


def odd_labels(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are no label line, or whose label does not start with the first word of the tag value."""
    kind, label = F.regexp_extract(column, _FORM, 2), F.regexp_extract(column, _FORM, 3)
    first = F.split(F.replace(kind, F.lit(":"), F.lit("_")), "_")[0]
    return lines.filter(~F.col(column).rlike(_FORM) | ~F.startswith(F.lower(label), F.lower(first)))
