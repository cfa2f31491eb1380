"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

Pieces of one length are interchangeable, so the packing is decided on the number of pieces of each length: a
table no longer than the capacity, whatever the number of documents. The lengths are taken in descending order, and
a segment tree over the remaining capacities finds the tightest open bin for the next run of equal pieces. Each
step becomes a row of a plan: pieces from this place of the descending order on go to these bins at this offset.
The plan's size depends on the capacity only. Spark counts, sorts and looks the pieces up.

Nulls: a null text is empty (the end id alone), a null doc_id is kept. Repeated rows are packed each; equal lengths go
by doc_id, piece and checksum. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.token_files import crc32_of_ids
from placeforge.llm.tokens import default_tokenizer, encode_texts, with_end
from placeforge.llm.words import list_array, slices, texts_of
from placeforge.operators.ordered import position_in_table
from placeforge.session import durable

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece of at most ``capacity`` ids of the encoded document; ``ids`` only if asked for."""
    tokenizer = tokenizer or default_tokenizer()
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            ids, lengths = with_end(*encode_texts(texts, tokenizer), end_id)
            n = -(-lengths // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            size = np.minimum(capacity, lengths[row] - piece * capacity)
            out = [
                rows.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * capacity, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc32_of_ids(ids, size), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(out + [list_array(ids, size, pa.int32())] * with_ids, names)

    return texts_of(docs).mapInArrow(cut, schema)


class FreeSpace:
    """Segment tree over the remaining capacities 0 to ``most``: how many open bins have each."""

    def __init__(self, most: int):
        self.half = 1 << most.bit_length()
        self.count = [0] * (2 * self.half)

    def add(self, space: int, bins: int) -> None:
        at = space + self.half
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that an open bin has."""
        at = need + self.half
        if self.count[at]:
            return need
        while at > 1:  # up to the first right neighbour that holds bins, then down its left side
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.half:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.half
            at >>= 1
        return None


class Step(NamedTuple):
    """``pieces`` pieces of ``length`` from place ``first`` on: ``each`` per bin, from ``bin`` on, from ``offset`` on."""

    first: int
    pieces: int
    length: int
    bin: int
    each: int
    offset: int


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Best-fit decreasing for so many pieces of each length (1 to ``capacity``); see the module's text."""
    tree, open_bins = FreeSpace(capacity), {}  # by remaining capacity: runs of bins as (first, count)
    steps, place, bins = [], 0, 0

    def leave(space: int, first: int, count: int) -> None:
        if space and count:
            open_bins.setdefault(space, []).append((first, count))
            tree.add(space, count)

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            space = tree.tightest(length)
            if space is None:
                space, each = capacity, capacity // length
                run = (bins, -(-left // each))
                bins += run[1]
            else:
                each = space // length
                run = open_bins[space].pop()
                tree.add(space, -run[1])
            # a bin that took one piece is the tightest for the next as long as it has room
            first, count = run
            full = min(count, left // each)
            rest = left - full * each if full < count else 0
            used = full + bool(rest)
            taken = full * each + rest
            steps.append(Step(place, taken, length, first, each, capacity - space))
            leave(space - each * length, first, full)
            if rest:
                leave(space - rest * length, first + full, 1)
            leave(space, first + used, count - used)
            place, left = place + taken, left - taken
    return steps


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece, length, ids_crc32) with ``sequence_id`` and ``offset``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = np.array(plan(counts, capacity) or [Step(0, 0, 1, 0, 1, 0)], dtype=np.int64)
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    placed = position_in_table(pieces, order, "_place")
    names = [c for c in placed.columns if c != "_place"]
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, `offset` long"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.column(b.schema.get_field_index("_place")).to_numpy() - 1
            step = steps[np.searchsorted(steps[:, 0], place, side="right") - 1]
            nth = place - step[:, 0]
            sequence, offset = step[:, 3] + nth // step[:, 4], step[:, 5] + nth % step[:, 4] * step[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(n)) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    return placed.mapInArrow(look_up, schema)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Cuts, then packs: (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack(durable(pieces_of(docs, capacity, tokenizer, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, doc_ids) of a packing with ids; at most ``capacity`` tokens meet in a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    lists = packed.groupBy("sequence_id").agg(parts.alias("p"))
    return lists.select("sequence_id", F.flatten("p.ids").alias("tokens"), F.col("p.doc_id").alias("doc_ids"))
