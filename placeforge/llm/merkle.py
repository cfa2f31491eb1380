"""Merkle manifest of a dataset: a hash tree for each language, one over all of them, and a proof for each row.

Leaves hash the fields of a row. Within a language they ascend by doc_id; every 8 consecutive nodes become their parent
until one is left. A row's place is counted over a range sort, and ``CHUNK`` consecutive places of a language are one
partition of a window ordered by place. Four levels are climbed there: a level's nodes stand on the first rows of
their subtrees, so its siblings are lag and lead columns at the fixed offsets 1 to 7 times the subtree's size, masked by
the node's slot and the length of its run, and the first child's row hashes the parent. The nodes of whole chunks go on as
the rows of the next climb. Then the rows are read again, meet the path of their chunk and fold their proof.
No language stands in one task, and no text or path is written; nodes above the leaves are an eighth of those below.

Nulls: any field may be null and is then ``-``; a null lang is a group of its own and comes first, a null doc_id comes
first in its group and is never tampered with. Repeated rows are leaves each; rows of one doc_id stand by leaf. Very
long texts are hashed whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.operators.ordered import position_in_group, position_in_table
from placeforge.operators.skew import with_groups
from placeforge.session import durable

FAN = 8
LEVELS = 4  # climbed in one window
CHUNK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    as_text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text), F.lit("-"))


def leaf_hash(**fields: Column) -> Column:
    return F.sha2(F.concat(*[_field(fields[name]) for name in FIELDS]), 256)


def lower_ascii(text: Column) -> Column:
    return F.when(text.rlike("[A-Z]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(text)


def tampered_rows(doc_id: Column) -> Column:
    """The rows on which the manifest is tried: a third by the id's checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, g, leaf, other, row_no), written; ``g`` orders languages with null first, ``other`` is the leaf of a tampered row."""
    own = {name: F.col(name) for name in FIELDS}
    other = F.when(tampered_rows(F.col("doc_id")), leaf_hash(**(own | {"text": lower_ascii(F.col("text").cast("string"))})))
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    return durable(
        docs.select(
            F.col("doc_id"), group.alias("g"), leaf_hash(**own).alias("leaf"), other.alias("other"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "leaves",
    )


def _climb(rows: DataFrame) -> DataFrame:
    """Adds ``path``, the siblings of a row's node on each level of its chunk, and ``top`` on a chunk's first row.

    ``rows`` has g, pos (from 0, without gaps), n (rows of the group) and h.
    """
    w = W.partitionBy("g", "chunk").orderBy("pos")
    pos, n = F.col("pos"), F.col("n")
    rows = rows.withColumn("chunk", F.expr(f"pos div {CHUNK}")).withColumn("top", F.col("h"))
    for level in range(LEVELS):
        size = FAN**level
        index, nodes = F.expr(f"pos div {size}"), F.ceil(n / F.lit(size))
        slot = index % FAN
        run = F.least(F.lit(FAN).cast("long"), nodes - (index - slot))
        is_node, goes_on = pos % size == 0, nodes > 1
        before = [F.when(slot >= i, F.lag("top", i * size).over(w)).otherwise("") for i in range(FAN - 1, 0, -1)]
        after = [F.when(slot + i < run, F.lead("top", i * size).over(w)).otherwise("") for i in range(1, FAN)]
        rows = rows.withColumn("_left", F.concat(*before)).withColumn("_right", F.concat(*after))
        siblings = F.when(is_node & goes_on, F.struct(F.col("_left").alias("left"), F.col("_right").alias("right")))
        parent = F.when(goes_on, F.sha2(F.concat("top", "_right"), 256)).otherwise(F.col("top"))
        rows = rows.withColumn(f"_s{level}", siblings).withColumn("top", F.when(is_node & (slot == 0), parent)).drop("_left", "_right")
    # a node stands on the first row of its subtree, so the last one before a row is the row's own
    own = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    found = [F.col("_s0"), *[F.last(f"_s{level}", ignorenulls=True).over(own) for level in range(1, LEVELS)]]
    path = F.filter(F.array(*found), lambda s: s.isNotNull())
    return rows.withColumn("path", path).drop(*[f"_s{level}" for level in range(LEVELS)])


def _tops(rows: DataFrame) -> DataFrame:
    """The rows of the next climb: one node for each chunk."""
    chunks = _climb(rows).filter(F.col("pos") % CHUNK == 0)
    return chunks.select("g", F.col("chunk").alias("pos"), F.ceil(F.col("n") / F.lit(CHUNK)).alias("n"), F.col("top").alias("h"))


def _climb_all(rows: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """(rows of each climb, the one node that is left of each group as g, h)."""
    climbs = [rows]
    while largest > 1:
        climbs.append(durable(_tops(climbs[-1]), "nodes"))
        largest = -(-largest // CHUNK)
    return climbs, climbs.pop()


def _with_paths(climbs: list[DataFrame], groups: DataFrame) -> DataFrame:
    """The first climb's rows with all columns of ``groups`` (g, up, ...) and with ``up`` the path all the way."""
    facts, last = [c for c in groups.columns if c != "g"], None
    for rows in reversed([_climb(c).drop("top") for c in climbs]):
        if last is None:  # rows of the groups' last climb: at most CHUNK of each
            met = rows.join(groups, "g")
        else:
            above = last.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), *facts)
            met = rows.join(above, (F.col("g") == F.col("_g")) & (F.col("chunk") == F.col("_pos"))).drop("_g", "_pos")
        last = met.withColumn("up", F.concat("path", "up")).drop("path", "chunk")
    return last


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang_group, leaf, other, subroot, root, up (siblings by level, left and right)."""
    placed = position_in_group(leaves(docs), ["g"], [F.col("doc_id"), F.col("leaf"), F.col("row_no")])
    sizes = durable(placed.groupBy("g").agg(F.count("*").alias("n")), "sizes")
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = with_groups(placed.withColumn("pos", F.col("pos") - 1), sizes, ["g"], "n", total, F.col("row_no"))
    rows = durable(placed.select("doc_id", "g", "other", "pos", "n", F.col("leaf").alias("h")), "placed")
    climbs, subroots = _climb_all(rows, largest)
    # the languages' nodes are the leaves of one more tree
    ranked = position_in_table(subroots.select("g", "h"), [F.col("g")], "pos")
    ranked = durable(ranked.select(F.col("g").alias("lang_group"), F.col("h").alias("subroot"), "h", (F.col("pos") - 1).alias("pos")), "subroots")
    groups = ranked.count()
    over = ranked.select(F.lit("").alias("g"), "lang_group", "subroot", "pos", F.lit(groups).cast("long").alias("n"), "h")
    upper, top = _climb_all(over, groups)
    root = (top.select("h").first() or [None])[0]
    if not upper:  # one language, or none
        upper = [over]
    none = docs.sparkSession.createDataFrame([("", [])], f"g string, up {PATH}")
    paths = _with_paths(upper, none).select(F.col("lang_group").alias("g"), "subroot", "up")
    paths = durable(paths, "group_paths")
    if not climbs:  # each language is a single leaf
        climbs = [rows]
    # paths of whole languages reach the rows of a language's last climb; of these no group has more than CHUNK
    found = _with_paths(climbs, paths)
    return found.select("doc_id", F.col("g").alias("lang_group"), F.col("h").alias("leaf"), "other", "subroot", F.lit(root).alias("root"), "up")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def verify(found: DataFrame) -> DataFrame:
    """The manifest's rows as digests: the proof, and the root that the leaf, or that of the tampered row, folds to."""
    proof = F.sha2(F.array_join(F.transform("up", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = fold(F.coalesce("other", "leaf"), F.col("up"))
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
