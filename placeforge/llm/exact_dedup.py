"""Exact duplicates by an index of live digests: cuckoo filters in front of buckets of stored keys.

Texts are equal when they are identical after lower-casing A-Z. A text's key is the SHA-256 of its normalised UTF-8.
Each task first folds its own rows in an index, so that a hot text leaves a task once; the folded keys meet by digest
in a second index. A filter hit is verified against the bucket's stored keys; a row with a larger id deletes the live key
it replaces and inserts its own. A full filter is rebuilt at twice the size from the stored keys.

Nulls: a null text is empty. A null doc_id counts as smaller than any other. Of repeated rows (same id and text) one
stays. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.skew import with_groups
from placeforge.session import durable

KEYS_PER_INDEX = 200_000  # live keys that a task holds before it hands them on
SLOTS, KICKS = 4, 200
KEYS = "digest binary, last_id long, last_row long, n long"


class CuckooIndex:
    """Live keys (digest, id, row, number of copies) with insertion, verified look-up and deletion."""

    def __init__(self, buckets: int = 1 << 10):
        self.live = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * SLOTS * buckets))  # fingerprints, 0 for none
        self.stored: list[list | None] = [None] * buckets  # keys by their first bucket

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        head = int.from_bytes(digest[:8], "little")
        mark = (head >> 48) or 1
        first = head & self.mask
        return mark, first, first ^ (mark * 0x5BD1E995 & self.mask)

    def find(self, digest: bytes) -> list | None:
        """The live key, or None; a filter hit alone proves nothing and is checked against the bucket."""
        mark, first, second = self._places(digest)
        if mark not in self.slots[first * SLOTS : first * SLOTS + SLOTS] and mark not in self.slots[second * SLOTS : second * SLOTS + SLOTS]:
            return None
        for key in self.stored[first] or ():
            if key[0] == digest:
                return key
        return None

    def _place(self, mark: int, first: int, second: int) -> bool:
        slots, turn, at = self.slots, mark, first
        for bucket in (first, second):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not slots[s]:
                    slots[s] = mark
                    return True
        for kick in range(KICKS):  # put a resident out to its other bucket
            s = at * SLOTS + (turn + kick) % SLOTS
            slots[s], turn = turn, slots[s]
            at ^= turn * 0x5BD1E995 & self.mask
            for free in range(at * SLOTS, at * SLOTS + SLOTS):
                if not slots[free]:
                    slots[free] = turn
                    return True
        return False

    def _rebuild(self) -> None:
        keys = list(self.keys())
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._empty(buckets)
            if all(self._store(key) for key in keys):
                return

    def _store(self, key: list) -> bool:
        mark, first, second = self._places(key[0])
        if self.stored[first] is None:
            self.stored[first] = []
        self.stored[first].append(key)
        return self._place(mark, first, second)

    def insert(self, key: list) -> None:
        """Adds a key whose digest is not live."""
        self.live += 1
        if not self._store(key):
            self._rebuild()

    def delete(self, key: list) -> None:
        """Removes a live key and its fingerprint."""
        mark, first, second = self._places(key[0])
        self.stored[first].remove(key)
        for bucket in (first, second):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[s] == mark:
                    self.slots[s] = 0
                    self.live -= 1
                    return

    def keys(self) -> Iterator[list]:
        for bucket in self.stored:
            yield from bucket or ()

    def add(self, digest: bytes, last_id: int | None, last_row: int, n: int) -> None:
        """Counts ``n`` copies; the key with the larger id stays live. A negative ``n`` takes copies away."""
        old = self.find(digest)
        if old is None:
            self.insert([digest, last_id, last_row, n])
            return
        rank = lambda i, r: (i is not None, i or 0, r)
        new_wins = n > 0 and rank(last_id, last_row) > rank(old[1], old[2])
        total = old[3] + n
        if new_wins or not total:
            self.delete(old)
            if total:
                self.insert([digest, last_id, last_row, total])
        else:
            old[3] = total


def digests_of(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, _row, digest) per row of ``docs``, written; ``_row`` is unique, from the column ``row`` if there is one."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.ascii_lower(pc.fill_null(b.column(2), ""))
            found = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["doc_id", "_row", "digest"])

    number = (F.col(row) if row else F.monotonically_increasing_id()).alias("_row")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number, F.col("text").cast("string").alias("text"))
    return durable(rows.mapInArrow(digest, "doc_id long, _row long, digest binary"), "digests")


def _index(keys: DataFrame) -> DataFrame:
    """Folds keys within each partition; it may be sorted by digest, then a digest leaves it once."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows = list(index.keys())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                ["digest", "last_id", "last_row", "n"],
            )

        index, before = CuckooIndex(), None
        for b in batches:
            for digest, last_id, last_row, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if index.live >= KEYS_PER_INDEX and digest != before:
                    yield out()
                    index = CuckooIndex()
                index.add(digest, last_id, last_row, n)
                before = digest
        yield out()

    return keys.mapInArrow(fold, KEYS)


def live_keys(rows: DataFrame, index: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The index after ``rows`` (doc_id, _row, digest) were inserted and the copies in ``removed`` taken away.

    ``index`` is an earlier result to go on from. A removed copy only lowers the count of its key, and the last one
    deletes the key; the id on a key is the largest ever inserted since the key became live.
    """
    one = rows.select("digest", F.col("doc_id").alias("last_id"), F.col("_row").alias("last_row"), F.lit(1).cast("long").alias("n"))
    keys = _index(one)
    if index is not None:
        keys = keys.union(index.select("digest", "last_id", "last_row", "n"))
    if removed is not None:
        gone = removed.select("digest", F.col("doc_id").alias("last_id"), F.col("_row").alias("last_row"), F.lit(-1).cast("long").alias("n"))
        keys = keys.union(gone)
    # insertions of a digest come before its deletions
    merged = _index(keys.repartition("digest").sortWithinPartitions("digest", F.col("n").desc()))
    return merged.filter("n > 0")


def duplicate_groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per document: doc_id, _row, digest, keep_id, group_size, kept; ``row`` names a unique number of a row.

    Of equal texts the row with the largest doc_id is kept; of repeated rows the last one.
    """
    rows = digests_of(docs, row)
    groups = durable(live_keys(rows).filter("n > 1"), "groups")
    met = with_groups(rows, groups, "digest", "n", rows.count(), F.col("_row"))
    group = F.col("group")
    return met.select(
        "doc_id", "_row", "digest",
        F.when(group.isNull(), F.col("doc_id")).otherwise(group["last_id"]).alias("keep_id"),
        F.coalesce(group["n"], F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(group["last_row"] == F.col("_row"), F.lit(True)).alias("kept"),
    )
