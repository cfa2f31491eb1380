"""Positions and lists within ordered groups of any size, and positions in a whole table.

A window over one group runs in one task, so a group that holds much of the table would stall. Here the
rows are range-sorted by (group, order), so that a large group spans many partitions; a row's position is
its place in its partition plus the rows of the group in earlier partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.session import durable

PAGE = 1000  # entries per page of a list


def _sorted_table(rows: DataFrame, by: list[Column], range_by: list[Column] | None = None) -> DataFrame:
    ranged = rows.repartitionByRange(*(range_by or by)).sortWithinPartitions(*by)
    # the id holds the partition in its upper bits and the row within the partition in its lower 33
    numbered = ranged.withColumn("_id", F.monotonically_increasing_id())
    placed = numbered.select(
        "*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(2**33 - 1).alias("_row")
    ).drop("_id")
    return durable(placed, "sorted")


def position_in_group(rows: DataFrame, keys: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """``row_number() over (partition by keys order by order)``; ``order`` must be total."""
    table = _sorted_table(rows, [*map(F.col, keys), *order])
    runs = table.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_from"))
    # one row per (group, partition), so this window sees at most one row per partition for a group
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from") + 1).alias("_shift"),
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return table.join(runs, same).select(*rows.columns, (F.col("_row") + F.col("_shift")).cast("long").alias(name))


def sum_before_in_group(rows: DataFrame, keys: list[str], order: list[Column], size: Column, name: str) -> DataFrame:
    """Adds the sum of ``size`` over the rows of the group that come before; ``order`` must be total."""
    table = _sorted_table(rows.withColumn("_size", size.cast("long")), [*map(F.col, keys), *order])
    own = W.partitionBy(*keys, "_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
    within = table.select(*keys, "_part", "_row", F.coalesce(F.sum("_size").over(own), F.lit(0)).alias("_in"))
    runs = table.groupBy(*keys, "_part").agg(F.sum("_size").alias("_n"))
    # one row per (group, partition), as above
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    sums = within.join(runs, same).select("_part", "_row", (F.col("_in") + F.col("_before")).alias(name))
    return table.join(sums, ["_part", "_row"]).select(*rows.columns, name)


def position_in_table(
    rows: DataFrame, order: list[Column], name: str, range_by: list[Column] | None = None
) -> DataFrame:
    """``row_number() over (order by order)`` without bringing the table into one task.

    ``range_by`` are leading sort columns that suffice to spread the rows.
    """
    table = _sorted_table(rows, order, range_by)
    counts = table.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row per partition of the table: small enough for one task and for a broadcast
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    return table.join(F.broadcast(shifts), "_part").select(
        *rows.columns, (F.col("_row") + F.col("_shift") + 1).cast("long").alias(name)
    )


def running_lists(
    rows: DataFrame, keys: list[str], order: list[Column], values: list[str], page: int = PAGE
) -> tuple[DataFrame, DataFrame]:
    """Lists of ``values`` over each row's group, as references into shared pages: (rows, pages).

    ``rows`` gain pos, page and length: the list up to a row is all earlier pages and the first ``length`` items of its page,
    the whole list all pages of the group. So the lists of a group of n rows take n items, not n * n.
    """
    placed = position_in_group(rows, keys, order, "pos")
    paged = placed.withColumn("page", F.expr(f"(pos - 1) div {page}"))
    paged = durable(paged.withColumn("length", (F.col("pos") - F.col("page") * page).cast("int")), "listed")
    items = F.array_sort(F.collect_list(F.struct("pos", *values)))
    pages = paged.groupBy(*keys, "page").agg(items.alias("items"))
    bare = F.transform("items", lambda i: F.struct(*[i[v].alias(v) for v in values]))
    return paged, durable(pages.select(*keys, "page", bare.alias("items")), "list-pages")


def lists_on_rows(rows: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``running_lists`` with ``items``, their own page whole; a page meets at most its own rows."""
    own = pages.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("page").alias("_page"), "items")
    same = F.col("page") == F.col("_page")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(own, same).select(*rows.columns, "items")


def list_pages(rows: DataFrame, keys: list[str], order: list[Column], values: list[str], page: int = PAGE) -> DataFrame:
    """Ordered lists per group in pages: (keys, page, items), items an array of structs of ``values``.

    All groups of at most ``page`` rows have one page, number 0; longer lists continue on further pages,
    so no group has to fit in one task.
    """
    placed = position_in_group(rows, keys, order, "_pos")
    item = F.struct("_pos", *values)
    paged = placed.withColumn("page", F.floor((F.col("_pos") - 1) / page))
    lists = paged.groupBy(*keys, "page").agg(F.array_sort(F.collect_list(item)).alias("items"))
    bare = F.transform("items", lambda i: F.struct(*[i[v].alias(v) for v in values]))
    return lists.select(*keys, "page", bare.alias("items"))
