"""Connected components of an edge table, by alternating large-star and small-star steps.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in MapReduce and Beyond (2014).
The number of rounds grows with the logarithm of the graph, also for long chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.operators.skew import with_groups
from placeforge.session import durable, forget


def _with_least(rows: DataFrame, total: int) -> DataFrame:
    """Rows (u, v) with ``m``, the smallest v of their u or u itself; a node with most of the rows is no bottleneck."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n"))
    return with_groups(rows, least, ["u"], "_n", total, F.col("v")).select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node hands its smallest neighbour to its larger neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = _with_least(both, 2 * total).filter("v > u")
    return met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node hands its smallest neighbour to itself and to its smaller neighbours."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _with_least(down, total)
    rest = met.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return rest.union(met.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Size and order-free hash of an edge set."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; a component is named by its smallest node.

    ``edges`` has integer columns ``u, v``.
    """
    current = durable(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    before = _state(current)
    while before[0]:
        previous, current = current, durable(_small_star(_large_star(current, before[0]), before[0]), "edges")
        forget(previous)
        after = _state(current)
        if after == before:
            break
        before = after
    # now stars: every node but the smallest has one edge, to the smallest
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
