"""Similarity join of whole texts on the Jaccard similarity of their word n-gram sets, by MinHash banding.

Band and row counts are chosen for a target recall at the threshold. Texts with one n-gram set are one set from there on.
Band hashes are shuffled; the sets that share a bucket are linked to its smallest, and the components of these links are
the candidate groups. Groups are cut into blocks of bounded size, and every pair of blocks is verified in a task on the
full n-gram sets. A task gives the number of links of each set and a spanning forest of them: no pair leaves a task, and a
group of n sets costs a row per set and block.

Words are runs without ASCII white space in lower case. A text of fewer than n words has one n-gram, all its words; a
text without words has an empty set, equal to any other empty one and to nothing else.

Nulls: a null text is empty; null ids are kept, but rows with null ids and texts of their own are told apart by their
sets only. Repeated rows are copies of each other. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.skew import inner_groups, with_groups
from placeforge.llm.words import bounds, slices, split_words, sums_by_row, texts_of
from placeforge.operators.components import connected_components
from placeforge.session import durable

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995  # of pairs exactly at the threshold, by bands alone
HASHES = 160  # at most
BLOCK_SETS, BLOCK_GRAMS = 512, 400_000
CHUNK = 1 << 15
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows per band): the most selective pair that reaches the recall with so many hashes."""
    best = (max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold))), 1)
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * by
    return x ^ (x >> np.uint64(29))


def _multipliers(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _MIX_A, _MIX_B) | np.uint64(1)


def ngram_sets(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the different n-grams of all texts, sorted within a text; how many each text has)."""
    counts, codes, words = split_words(pc.utf8_lower(texts))
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))[codes]
    at = bounds(counts)
    rows, grams = [], []
    whole = np.flatnonzero(counts >= n)
    if len(whole):
        places = np.concatenate([np.arange(at[i], at[i + 1] - n + 1) for i in whole.tolist()])
        value = np.zeros(len(places), np.uint64)
        for k in range(n):
            value = value * _MIX_B + hashed[places + k]
        rows.append(np.repeat(whole, counts[whole] - n + 1))
        grams.append(_mixed(value, _MIX_A))
    for i in np.flatnonzero((counts > 0) & (counts < n)).tolist():
        value = np.uint64(counts[i])
        for w in hashed[at[i] : at[i + 1]].tolist():
            value = np.uint64((int(value) * int(_MIX_B) + w) & 0xFFFFFFFFFFFFFFFF)
        rows.append(np.array([i]))
        grams.append(_mixed(np.array([value], np.uint64), _MIX_A))
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return gram[first], np.bincount(row[first], minlength=len(counts)).astype(np.int64)


def band_hashes(grams: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(non-empty sets, bands) of 64-bit hashes; the band's number is part of its hash."""
    sizes = sizes[sizes > 0]
    out = np.empty((len(sizes), bands), np.uint64)
    multipliers, at = _multipliers(bands * rows), bounds(sizes)
    first = 0
    while first < len(sizes):  # a few sets at a time stay in the processor's cache
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, side="right")) - 1)
        part, starts = grams[at[first] : at[last]], at[first:last] - at[first]
        value = np.zeros(last - first, np.uint64)
        for k, m in enumerate(multipliers):
            if k % rows == 0:
                value = np.full(last - first, k + 1, np.uint64)
            value = value * _MIX_B + np.minimum.reduceat(part * m, starts)
            if k % rows == rows - 1:
                out[first:last, k // rows] = _mixed(value, _MIX_A)
        first = last
    return out


def _set_key(grams: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes and the size, equal for equal sets: two sums of mixed hashes."""
    both = [sums_by_row(_mixed(grams, m), sizes) for m in (_MIX_A, _MIX_B)]
    return [a.tobytes() + b.tobytes() + n.tobytes() for a, b, n in zip(*both, sizes, strict=True)]


def sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, set_key, n_grams, bands) per document, written."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            grams, sizes = ngram_sets(texts, n)
            found = band_hashes(grams, sizes, bands, rows).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(bounds((sizes > 0) * bands), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_set_key(grams, sizes), pa.binary()), pa.array(sizes), lists], ["doc_id", "set_key", "n_grams", "bands"]
            )

    return durable(texts_of(docs).mapInArrow(sketch, "doc_id long, set_key binary, n_grams long, bands array<long>"), "sketches")


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, component) of sets that share a bucket, directly or through others."""
    rows = sets.select("set_id", F.explode("bands").alias("h"))
    buckets = durable(rows.groupBy("h").agg(F.min("set_id").alias("least"), F.count("*").alias("m")).filter("m > 1"), "buckets")
    links = inner_groups(rows, buckets, "h", "m", sets.count())
    return connected_components(links.select(F.col("set_id").alias("u"), F.col("group.least").alias("v")))


def _verify(ids: np.ndarray, copies: np.ndarray, side: np.ndarray, grams: np.ndarray, sizes: np.ndarray, threshold: float):
    """(links per set, edges of a spanning forest): all pairs of one block, or all pairs across two (``side`` 0 and 1)."""
    n, across = len(ids), bool(side.any())
    _, place = np.unique(grams, return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(place, kind="stable")
    holders, times = owner[order], np.bincount(place)
    starts = bounds(times)[:-1]
    at, links, root, edges = bounds(sizes), np.zeros(n, np.int64), list(range(n)), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        own = place[at[i] : at[i + 1]]
        before = bounds(times[own])
        others = holders[np.arange(before[-1]) + np.repeat(starts[own] - before[:-1], times[own])]
        common = np.bincount(others, minlength=n)
        alike = common >= threshold * (sizes[i] + sizes - common) - 1e-9
        alike[i] = False
        if across:
            alike &= side != side[i]
        near = np.flatnonzero(alike)
        links[i] = copies[near].sum()
        for j in near[near > i].tolist():
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                edges.append((ids[i], ids[j]))
    return links, edges


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """(u, v, links): with v an edge of a spanning forest of the links, without v the number of linked documents of u."""
    members = durable(sets.drop("bands").join(groups, F.col("set_id") == F.col("node")), "members")
    sums = members.groupBy("component").agg(F.count("*").alias("m"), F.sum("n_grams").alias("g"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("g") / BLOCK_GRAMS)).cast("int")
    sums = durable(sums.filter("m > 1").select("component", "m", blocks.alias("blocks")), "group_sizes")
    wanted = inner_groups(members, sums, "component", "m", members.count())
    wanted = wanted.select("set_id", "set_key", "first_doc", "copies", "component", F.col("group.blocks").alias("blocks"))
    texts = texts_of(docs).join(wanted.select("first_doc"), F.col("doc_id").eqNullSafe(F.col("first_doc")), "left_semi")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in slices(batches):
            grams, sizes = ngram_sets(part, n)
            raw, at = grams.tobytes(), (bounds(sizes) * 8).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(_set_key(grams, sizes), pa.binary()), pa.array([raw[a:b] for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["key", "grams"]
            )

    sets_of = texts.mapInArrow(shingle, "key binary, grams binary").dropDuplicates(["key"])
    full = sets_of.join(wanted, F.col("key") == F.col("set_key"))
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    other = full.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = [F.col("component"), F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")]
    rows = other.select(*tile, (F.col("own") > F.col("other")).cast("int").alias("side"), "set_id", "copies", "grams")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: pa.Table) -> pa.RecordBatch:
            raw = held.column("grams").to_pylist()
            sizes = np.array([len(r) // 8 for r in raw], np.int64)
            ids, copies, side = (held.column(c).to_numpy() for c in ("set_id", "copies", "side"))
            if held.column("a")[0].as_py() != held.column("b")[0].as_py() and not side.any():
                links, edges = np.zeros(len(ids), np.int64), []  # the other block is empty
            else:
                links, edges = _verify(ids, copies, side, np.frombuffer(b"".join(raw), np.uint64), sizes, threshold)
            u = np.concatenate([ids, np.array([e[0] for e in edges], np.int64)])
            v = [None] * len(ids) + [int(e[1]) for e in edges]
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v, pa.int64()), pa.array(np.concatenate([links, np.zeros(len(edges), np.int64)]))], ["u", "v", "links"])

        held: list[pa.Table] = []
        current = None
        for b in batches:
            tiles = np.column_stack([b.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((tiles[1:] != tiles[:-1]).any(axis=1)) + 1).tolist(), len(tiles)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if x == y:
                    continue
                if held and tuple(tiles[x]) != current:
                    yield out(pa.concat_tables(held))
                    held = []
                current = tuple(tiles[x])
                held.append(pa.Table.from_batches([b.slice(x, y - x)]))
        if held:
            yield out(pa.concat_tables(held))

    keys = ["component", "a", "b"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return durable(dealt.mapInArrow(verify, "u long, v long, links long"), "links")


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, n: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_id, n_copies.

    ``n_links`` counts the other documents with a similarity of at least ``threshold``, copies too. ``class_id`` is the smallest
    doc_id among the documents linked to it, directly or through others; ``copy_id`` and ``n_copies`` are the smallest
    doc_id and the number of documents with the same n-gram set.
    """
    rows = sketches(docs, n, *choose_bands(threshold, recall))
    sets = rows.groupBy("set_key").agg(
        F.first("n_grams").alias("n_grams"), F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("bands").alias("bands")
    )
    sets = durable(sets.withColumn("set_id", F.monotonically_increasing_id()), "sets")
    groups = candidate_groups(sets.select("set_id", "bands"))
    found = verified_links(docs, sets, groups, n, threshold)
    classes = connected_components(found.filter("v is not null").select("u", "v"))
    links = found.filter("v is null").groupBy("u").agg(F.sum("links").alias("links")).filter("links > 0")
    known = sets.select("set_id", "set_key", "first_doc", "copies").join(classes, F.col("set_id") == F.col("node"), "left")
    known = known.join(links, F.col("set_id") == F.col("u"), "left").filter("copies > 1 or links > 0")
    known = durable(known.withColumn("component", F.coalesce("component", "set_id")).drop("node", "u"), "known")
    # the smallest document of each class; partial results are combined before they meet
    least = durable(known.groupBy("component").agg(F.min("first_doc").alias("class_id"), F.count("*").alias("m")), "classes")
    facts = inner_groups(known, least, "component", "m", known.count()).select(
        "set_key", "copies", F.col("first_doc").alias("copy_id"), F.col("group.class_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    met = with_groups(rows.select("doc_id", "set_key"), durable(facts, "facts"), "set_key", "copies", rows.count(), F.xxhash64("doc_id"))
    group, alone = F.col("group"), F.col("group").isNull()
    return met.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(group["class_id"]).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(group["n_links"]).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(group["copy_id"]).alias("copy_id"),
        F.when(alone, F.lit(1)).otherwise(group["copies"]).cast("long").alias("n_copies"),
    )
