"""Language model scores of whole texts by a probabilistic suffix tree.

Tokens are words (runs without ASCII white space, A-Z lower-cased) and one end for each text. Each word shows the tree
a symbol: a word that occurs ``OWN_COUNT`` times or more its own, any other word its last two bytes. So the symbols grow with the
corpus; those of endings are at most ``ENDINGS``. The tree holds contexts of up to ``DEPTH`` last symbols: a context is a candidate if
it occurs ``LEAST_CONTEXT`` times or more in training texts, and it is kept if its next symbols diverge enough from what its next
shorter suffixes say (``LEAST_GAIN``). Both bounds are absolute counts, so more text gives more contexts.

A kept context seen m times, followed by t different symbols, says n / (m + t) for a symbol that followed it n times (twice at
least) and leaves the rest of its mass, that of symbols seen once included, to the next shorter kept suffix. A word's probability is that of its symbol
from the longest kept context on, times the word's among all words of the symbol, by counts with one added and one place for words never seen.

Words are counted exactly. Documents are coded in blocks of bounded size against the block's own words; only (block,
word) rows meet by word, and the counts go back by block, so a frequent word is a row per block. Contexts and next
symbols are Spark tables keyed by a hash of the symbols (64 bits). Next symbols are counted by parts of the key space, packed: their number grows
with the texts and the rows of a part do not. There a sum meets the probability that one symbol less gives it, so texts are not looked up to learn. To score,
each block of texts asks for the counts that follow kept contexts, as numbers of contexts and symbols packed by part, and they come back in that order.
Symbols, candidates and contexts are broadcast while each has at most ``BROADCAST_KEYS`` rows, counts while all have a small part of it;
if contexts alone are too many, a block of texts meets all rows it needs. The switch chooses a plan, not a result.

Nulls: a null text is empty and has the end alone. A null doc_id is kept and its remainder is that of an empty text.
Repeated rows are scored and learnt each. Very long texts are whole rows of a block of their own. Ties: nothing is ranked. Without training rows all
counts are 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.llm.words import bounds, slices, split_words, sums_by_row
from placeforge.operators.ordered import position_in_group
from placeforge.session import durable, forget, forget_shuffles

OWN_COUNT = 500  # a word that occurs as often has a symbol of its own
DEPTH = 3  # symbols of the longest context
LEAST_CONTEXT = 100  # a candidate context occurs as often
LEAST_GAIN = 20.0  # natural log units that a context must gain over its shorter suffixes, and 1 for each next symbol it has
BROADCAST_KEYS = 8_000_000  # about 25 bytes each in a task
ENDINGS = 256 + 65_536  # words of one byte, and the last two bytes of all others
END = 0  # symbol of the end; own symbols are even numbers by falling count, endings odd ones

BLOCKS = "block long, doc_id long, held_out boolean, codes binary, word binary, code int, ending int, n long"
SUMS = "block long, doc_id long, held_out boolean, n_known long, log_counts double, log_words double, symbols binary"


def _endings(words: pa.Array) -> np.ndarray:
    """Number of the last one or two bytes of each word; words are not empty."""
    raw = words.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    last = data[ends[1:] - 1].astype(np.int32) if len(raw) else np.zeros(0, np.int32)
    before = np.where(np.diff(ends) > 1, data[ends[1:] - 2].astype(np.int32) + 1, 0) if len(raw) else last
    return before * 256 + last


def pack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all codes, bytes per code): seven bits a byte, lowest first, the top bit on all but a code's last byte."""
    size = 1 + sum((codes >= 1 << (7 * k)).astype(np.int64) for k in range(1, 5))
    at, out = bounds(size)[:-1], np.zeros(size.sum(), np.uint8)
    for k in range(5):
        some = size > k
        out[at[some] + k] = (codes[some] >> (7 * k) & 127) | np.where(size[some] > k + 1, 128, 0)
    return out, size


def unpack(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    found = np.zeros(len(ends), np.int64)
    for k in range(5):
        some = ends - starts >= k
        found[some] |= (raw[starts[some] + k] & 127).astype(np.int64) << (7 * k)
    return found


def code_blocks(docs: DataFrame) -> DataFrame:
    """One written table of two kinds of rows: a row per document with its word codes, and for each block of
    documents a row per different word with its number in the block's training rows."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        names = [f.split()[0] for f in BLOCKS.split(", ")]
        kinds = (pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
        for rows, texts in slices(batches):
            counts, codes, words = split_words(pc.ascii_lower(texts))
            times = np.bincount(codes, minlength=len(words))
            order = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]  # frequent words have short codes
            rank = np.zeros(len(words), np.int64)
            rank[order] = np.arange(len(order))
            codes, words = rank[codes], words.take(pa.array(order))
            raw, size = pack(codes)
            ends = bounds(sums_by_row(size, counts)).tolist()
            raw = raw.tobytes()
            own = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            docs_part = [pa.array(np.full(len(counts), block), pa.int64()), rows.column(0), rows.column(1), pa.array(own, pa.binary())]
            yield pa.RecordBatch.from_arrays(docs_part + [pa.nulls(len(counts), k) for k in kinds[3:]], names)
            learnt = np.repeat(~rows.column(1).to_numpy(zero_copy_only=False), counts)
            n, ending = np.bincount(codes[learnt], minlength=len(words)), _endings(words)
            for first in range(0, len(words), 50_000):
                part = slice(first, min(len(words), first + 50_000))
                size_of = part.stop - first
                some = [
                    words.slice(first, size_of).cast(pa.binary()), pa.array(np.arange(first, part.stop), pa.int32()), pa.array(ending[part], pa.int32()),
                    pa.array(n[part], pa.int64()),
                ]
                blank = [pa.nulls(size_of, k) for k in kinds[:3]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size_of, block), pa.int64()), *blank, *some], names)
            block += 1

    return durable(docs.select("doc_id", "held_out", "text").mapInArrow(code, BLOCKS), "blocks")


def count_words(blocks: DataFrame, own_count: int = OWN_COUNT) -> DataFrame:
    """(block, code, c, ending, hash, first): ``c`` is the word's number in all training rows; one row of each word is its first.

    A word has one row per block, so no word has more than one in as many rows as a block has words."""
    word = W.partitionBy("word")
    rows = blocks.filter("word is not null").select("block", "code", "ending", "n", "word")
    whole = rows.withColumn("c", F.sum("n").over(word)).withColumn("_b", F.min("block").over(word))
    name = F.when(F.col("c") >= own_count, F.xxhash64("word"))
    return durable(whole.select("block", "code", "c", "ending", name.alias("hash"), (F.col("_b") == F.col("block")).alias("first")), "words")


def symbols_of(words: DataFrame, most: int = BROADCAST_KEYS) -> tuple[DataFrame, Index | None]:
    """(block, code, c, symbol) of ``count_words``; with an index, words that have their own symbol show their hash, and it has the symbols."""
    own = words.filter("hash is not null")
    ranked = position_in_group(own.filter("first").select("hash", "c"), [], [F.desc("c"), F.col("hash")], "rank").select("hash", (2 * F.col("rank")).alias("symbol"))
    ending = 2 * F.col("ending").cast("long") + 1
    if own.filter("first").count() <= most:
        rows = words.select("block", "code", "c", F.coalesce("hash", ending).alias("symbol"))
        return rows, _index(ranked.select(F.col("hash").alias("key"), "symbol"))
    rest = words.filter("hash is null").select("block", "code", "c", ending.alias("symbol"))
    return rest.union(own.join(ranked, "hash").select("block", "code", "c", "symbol")), None


PART_KEYS = 1 << 19  # about as many keys of a table or a pass go to one part of the key space
PACK_ROWS = 1 << 20  # rows of a table that a task packs at once
COUNTS_SHARE = 32  # counts of sequences are broadcast up to this part of ``BROADCAST_KEYS`` only: each task holds them, and each broadcast is a file on each machine
KEPT_ROWS = 1_000_000  # as many contexts of a length are broadcast to a join
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Index:
    """Rows of a table by their 64-bit key, in arrays; ``find`` gives a row's place, or -1."""

    def __init__(self, table: pa.Table | dict[str, np.ndarray]):
        columns = table if isinstance(table, dict) else {c: table.column(c).to_numpy() for c in table.column_names}
        columns.pop("block", None)
        keys = columns.pop("key").view(np.uint64) * _M1  # one to one, and spread over all buckets
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        keys = self.keys[:-1]
        self.columns = {c: columns.pop(c)[order] for c in list(columns)}
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.empty(2**bits, np.int32)
        for first in range(0, 2**bits, 1 << 16):  # a few at a time: the driver holds this once for a broadcast
            some = np.arange(first, min(2**bits, first + (1 << 16)), dtype=np.uint64)
            self.starts[first : first + len(some)] = np.searchsorted(keys, some << self.shift)
        self.longest = int(np.diff(self.starts, append=np.int32(len(keys))).max(initial=0))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        wanted = wanted * _M1
        at = self.starts[wanted >> self.shift]
        for _ in range(self.longest):
            at += self.keys[at] < wanted
        return np.where(self.keys[at] == wanted, np.where(at < len(self.keys) - 1, at, -1), -1)


def _mix(before: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Key of a sequence from that of all but its last symbol and the last symbol."""
    x = ((before + _M2) ^ (symbols * _M1)) * _M2  # two ends are not the key of one
    x ^= x >> np.uint64(32)
    return x * _M2


def _index(rows: DataFrame) -> Index:
    """The index of a whole table, with small numbers where they do; what was collected is let go column by column."""
    table, columns = rows.toArrow(), {}
    while table.num_columns:
        column, name = table.column(0).to_numpy(), table.column_names[0]
        table = table.remove_column(0)
        columns[name] = column.astype(np.int32) if name == "n" and column.max(initial=0) < 2**31 else column
        del column
    pa.default_memory_pool().release_unused()
    return Index(columns)


_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))  # undoes the multiplication by _M1


def _bits_for(keys: float) -> int:
    """Bits that number the parts of the key space."""
    return (int(keys) // PART_KEYS).bit_length()


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all texts, an end before and after each, places per text with the last end, whether a place is one)."""
    packed = batch.column("symbols")
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    raw = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    counts = np.diff(bounds(raw < 128)[ends - ends[0]])
    flat = unpack(raw).astype(np.uint64)
    at = bounds(counts)
    line = np.insert(flat, np.concatenate([at[:-1], at[1:]]), np.uint64(END)) if len(counts) else flat
    place = np.ones(len(line), bool)
    place[bounds(counts + 2)[:-1]] = False
    return line, counts + 1, place


def _contexts(line: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key of the last 1, 2, ... symbols up to each place, whether they lie in its text), the end before a text included."""
    begin = ~place
    key, inside = line, np.ones(len(line), bool)  # one symbol is its own key
    yield key, inside
    for _ in range(1, depth):
        before, crossed = np.roll(key, 1), np.roll(inside, 1)
        key = _mix(before, line)
        inside = crossed & ~begin
        if len(inside):
            inside[0] = False
        yield key, inside


class Tree(NamedTuple):
    """Tables ``symbols`` (key, n), ``counts`` (key, ctx, n) of sequences that follow kept contexts and ``contexts`` (key, total, back)
    that are kept, keys of contexts whose rows go to all parts, and what the root needs."""

    symbols: DataFrame
    counts: DataFrame
    contexts: DataFrame
    heavy: np.ndarray
    root: float  # mass of all symbols


def _shorter(line: np.ndarray, place: np.ndarray, counts: Index, contexts: Index, root: float, depth: int) -> np.ndarray:
    """Probability of the symbol at each place by its kept contexts of up to ``depth`` symbols."""
    n_of, total_of, back_of = counts.columns["n"], contexts.columns["total"], contexts.columns["back"]
    sequences = list(_contexts(line, place, depth + 1))
    at = counts.find(sequences[0][0])
    p = (np.where(at >= 0, n_of[at] if len(n_of) else 0, 0) + 1.0) / root
    live = np.flatnonzero(place)
    for d in range(1, depth + 1):
        live = live[sequences[d][1][live]]
        c = contexts.find(sequences[d - 1][0][live - 1])
        some = c >= 0
        here, c = live[some], c[some]
        at = counts.find(sequences[d][0][here])
        n = np.where(at >= 0, n_of[at] if len(n_of) else 0, 0)
        p[here] = n / total_of[c] + back_of[c] * p[here]
    return p


def _parts(batch: pa.RecordBatch, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices with at most ``most`` bytes of symbols, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("symbols")).to_numpy().astype(np.int64) + 2)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


PACKED = "part int, ctx binary, suffix binary, nexts binary, next binary, low binary, n binary"


def _part_of(ctx: np.ndarray, key: np.ndarray, heavy: np.ndarray, bits: int) -> np.ndarray:
    """Part of sequences that are a context and a symbol: the context's, but sequences of heavy contexts go to all parts."""
    at = np.minimum(np.searchsorted(heavy, ctx), max(0, len(heavy) - 1))
    return (np.where(heavy[at] == ctx, key, ctx) if len(heavy) else ctx) * _M1 >> np.uint64(64 - bits)


def _heavy(candidates: DataFrame) -> np.ndarray:
    """Sorted keys of contexts that might fill a part, of (key, n); a table has few, as each occurs so often."""
    found = candidates.filter(F.col("n") * 8 > PART_KEYS).select("key").toArrow()
    return np.sort(found.column("key").to_numpy().view(np.uint64))


SUMMED = "key long, ctx long, low double, n long"


def _sum_part(packed: pa.Table, lower: Index | None, depth: int, root: float) -> pa.Table:
    """Rows (key, ctx, low, n) of the next symbols of a part that occur twice or more; ``low`` is their probability by contexts
    of up to ``depth`` symbols, which ``lower`` has by sequence, or at depth 0 the rows by counts."""
    nexts, after, n = (unpack(_joined(packed.column(c), "u1")) for c in ("nexts", "next", "n"))
    ctx, after = np.repeat(_joined(packed.column("ctx"), "u8"), nexts), after.astype(np.uint64)
    key = _mix(ctx, after)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    n = np.add.reduceat(n[order], first, dtype=np.int64) if len(key) else n
    first, n = first[n > 1], n[n > 1]
    at = order[first]
    if depth:
        suffix = np.repeat(_joined(packed.column("suffix"), "u8"), nexts)[at]
        low = lower.columns["v"][lower.find(_mix(suffix, after[at]))]  # what follows a context twice follows its suffix as often
    else:
        low = (unpack(_joined(packed.column("low"), "u1"))[at] + 1.0) / root
    return pa.table([pa.array(key[first].view(np.int64)), pa.array(ctx[at].view(np.int64)), pa.array(low), pa.array(n)], names=["key", "ctx", "low", "n"])


def _cut(codes: np.ndarray, at: np.ndarray) -> pa.Array:
    """Packed codes of each run; a run ends where the next one of ``at`` starts."""
    raw, size = pack(codes)
    ends, raw = bounds(size)[at].tolist(), raw.tobytes()
    return pa.array([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())


def _run_edges(part: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges of the runs of equal parts, edges of runs of equal contexts in them, the former as places among the latter)."""
    moved = part[1:] != part[:-1]
    edges = np.concatenate([[0], np.flatnonzero(moved) + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
    heads = np.concatenate([[0], np.flatnonzero(moved | (ctx[1:] != ctx[:-1])) + 1, [len(part)]]) if len(part) else edges
    return edges, heads, np.searchsorted(heads, edges)


def _pack_next(part: np.ndarray, ctx: np.ndarray, suffix: np.ndarray, after: np.ndarray, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of ``PACKED``, one for each part; ``part`` rises, and equal contexts of a part lie together. Without ``low`` its column is empty."""
    edges, heads, of_heads = _run_edges(part, ctx)
    columns = [pa.array(part[edges[:-1]].astype(np.int32))]
    for keys in (ctx[heads[:-1]], suffix[heads[:-1]]):
        columns.append(pa.array([keys[a:b].tobytes() for a, b in zip(of_heads, of_heads[1:], strict=False)], pa.binary()))
    columns += [_cut(np.diff(heads), of_heads), _cut(after, edges), _cut(low, edges if len(low) else np.zeros_like(edges)), _cut(n, edges)]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PACKED.split(", ")])


def _pack_counts(bits: int, heavy: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, ctx, v) to (part, keys, v) of many at once."""

    def packed(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(some)
        keys, ctx = (table.column(c).to_numpy().view(np.uint64) for c in ("key", "ctx"))
        part = _part_of(ctx, keys, heavy, bits)
        order = np.argsort(part, kind="stable")
        keys, v, (edges, _, _) = keys[order], table.column("v").to_numpy()[order], _run_edges(part[order], part[order])
        cut = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
        return pa.RecordBatch.from_arrays([
            pa.array(part[order][edges[:-1]].astype(np.int32)), pa.array([keys[r].tobytes() for r in cut], pa.binary()), pa.array([v[r].tobytes() for r in cut], pa.binary()),
        ], ["part", "keys", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACK_ROWS:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    return run


def _by_parts(
    sent: DataFrame, known: DataFrame, heavy: np.ndarray, bits: int, answer: Callable[[pa.Table, Index, int], pa.Table], depth: int, schema: str
) -> DataFrame:
    """``answer`` on the rows of each part of the key space, with the part's rows (key, ctx, v) of sequences that follow contexts of up to
    ``depth`` symbols."""
    kind = {"bigint": "i8", "double": "f8"}[dict(known.dtypes)["v"]]

    def meet(rows: pa.Table, packed: pa.Table) -> pa.Table:
        index = Index({"key": _joined(packed.column("keys"), "u8"), "v": _joined(packed.column("v"), kind)})
        return answer(rows, index, depth)

    packed = known.select("key", "ctx", "v").mapInArrow(_pack_counts(bits, heavy), "part int, keys binary, v binary")
    return sent.groupBy("part").cogroup(packed.groupBy("part")).applyInArrow(meet, schema)


Work = Callable[..., pa.RecordBatch]


def _over_texts(texts: DataFrame, counts: DataFrame, contexts: DataFrame, depth: int, work: Work, schema: str, most: int) -> DataFrame:
    """``work`` on all texts with the rows of both tables: the whole tables, or those that a block of texts needs."""

    def split(table: pa.Table) -> tuple[Index, Index]:
        counted = pc.is_valid(table.column("n"))
        return Index(table.filter(counted).select(["key", "n"])), Index(table.filter(pc.invert(counted)).select(["key", "total", "back"]))

    null = F.lit(None)
    tree = counts.select("key", "n", null.cast("double").alias("total"), null.cast("double").alias("back")).union(
        contexts.select("key", null.cast("long"), "total", "back")
    )
    if counts.count() + contexts.count() <= most:
        shared = texts.sparkSession.sparkContext.broadcast((_index(counts.select("key", "n")), _index(contexts)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _parts(whole):
                    yield work(batch, *shared.value)

        return texts.mapInArrow(run, schema)

    empty = texts.sparkSession.createDataFrame([], schema).toArrow()

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts(whole):
                for block in pc.unique(batch.column("block")).to_pylist():
                    line, _, place = _symbols(batch.filter(pc.equal(batch.column("block"), block)))
                    keys = np.unique(np.concatenate([k[inside] for k, inside in _contexts(line, place, depth + 1)])).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys)], ["block", "key"])

    rows = texts.mapInArrow(needed, "block long, key long").distinct().join(tree, "key").select("block", "key", "n", "total", "back")

    def meet(own: pa.Table, found: pa.Table) -> pa.Table:
        tables = split(found)
        done = [work(part, *tables) for batch in own.combine_chunks().to_batches() for part in _parts(batch)]
        return pa.Table.from_batches(done) if done else empty

    return texts.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(meet, schema)


class Asked(NamedTuple):
    """Different sequences of some texts that are a kept context and a next symbol, in the order in which they are asked for."""

    part: np.ndarray
    context: np.ndarray  # row of the context
    after: np.ndarray
    places: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # for each length: place, row of its context, row of the sequence


def _asked(line: np.ndarray, place: np.ndarray, kept: Index, depth: int, bits: int) -> Asked:
    live, found, before = np.flatnonzero(place), [], None
    for key, inside in _contexts(line, place, depth + 1):
        if before is not None:
            live = live[inside[live]]
            c = kept.find(before[live - 1])
            here = live[c >= 0]
            found.append((here, c[c >= 0], key[here]))
        before = key
    at, c, keys = (np.concatenate([f[k] for f in found]) for k in range(3))
    order = np.argsort(keys)
    fresh = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])[: len(keys)]
    first = order[fresh]
    at, c, keys, row = at[first], c[first], keys[first], np.empty(len(keys), np.int64)
    part = np.where(kept.columns["heavy"][c], keys * _M1, kept.keys[c]) >> np.uint64(64 - bits)
    by = np.argsort(part << np.uint64(32) | c.astype(np.uint64))
    back = np.empty(len(by), np.int64)
    back[by] = np.arange(len(by))
    row[order] = back[np.cumsum(fresh) - 1]
    rows = np.split(row, np.cumsum([len(f[0]) for f in found])[:-1])
    return Asked(part[by], c[by], line[at[by]].astype(np.int64), [(f[0], f[1], r) for f, r in zip(found, rows, strict=True)])


def _score_by_parts(texts: DataFrame, tree: Tree, n_counts: int, depth: int, score: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """``score`` on all texts with the probability at each place. Contexts and symbols are broadcast; what follows contexts goes to the
    parts of the key space, as numbers of contexts and symbols, and its counts come back in that order."""
    bits = _bits_for(n_counts)
    kept, root = _index(tree.contexts), tree.root
    keys = kept.keys[:-1] * _BACK
    kept.columns["heavy"] = np.isin(keys, tree.heavy)
    shared = texts.sparkSession.sparkContext.broadcast((_index(tree.symbols), kept))
    empty = texts.sparkSession.createDataFrame([], schema).toArrow()

    def pieces(own: pa.Table) -> Iterator[pa.RecordBatch]:
        """The same ones whatever the order of a block's rows, but for texts of equal symbols."""
        for batch in own.sort_by("symbols").combine_chunks().to_batches():
            yield from _parts(batch)

    asks = "block long, piece int, part int, ctx binary, nexts binary, next binary"

    def ask(own: pa.Table) -> pa.Table:
        block, done = own.column("block")[0], []
        for piece, batch in enumerate(pieces(own)):
            line, _, place = _symbols(batch)
            part, c, after, _ = _asked(line, place, shared.value[1], depth, bits)
            edges, heads, of_heads = _run_edges(part, c)
            rises = np.diff(c[heads[:-1]], prepend=0)
            rises[of_heads[:-1]] = c[edges[:-1]]
            n = len(edges) - 1
            done.append(pa.RecordBatch.from_arrays([
                pa.array([block.as_py()] * n, pa.int64()), pa.array([piece] * n, pa.int32()), pa.array(part[edges[:-1]].astype(np.int32)),
                _cut(rises, of_heads), _cut(np.diff(heads), of_heads), _cut(after, edges),
            ], [f.split()[0] for f in asks.split(", ")]))
        return pa.Table.from_batches(done)

    def answer(asked: pa.Table, counted: Index, _: int) -> pa.Table:
        contexts, found = shared.value[1].keys, []
        for raw in zip(*(asked.column(c).to_pylist() for c in ("ctx", "nexts", "next")), strict=True):
            rises, nexts, after = (unpack(np.frombuffer(x, np.uint8)) for x in raw)
            ctx = np.repeat(contexts[np.cumsum(rises)] * _BACK, nexts)
            at = counted.find(_mix(ctx, after.astype(np.uint64)))
            n = counted.columns["v"]
            found.append(pack(np.where(at >= 0, n[at] if len(n) else 0, 0))[0].tobytes())
        return asked.select(["block", "piece", "part"]).append_column("n", pa.array(found, pa.binary()))

    def meet(own: pa.Table, found: pa.Table) -> pa.Table:
        (symbols, contexts), done = shared.value, []
        total_of, back_of = contexts.columns["total"], contexts.columns["back"]
        for piece, batch in enumerate(pieces(own)):
            line, counts, place = _symbols(batch)
            mine = found.filter(pc.equal(found.column("piece"), piece)).sort_by("part")
            n_of = unpack(_joined(mine.column("n"), "u1"))
            at = symbols.find(line)
            p = (np.where(at >= 0, symbols.columns["n"][at] if len(symbols.columns["n"]) else 0, 0) + 1.0) / root
            for here, c, row in _asked(line, place, contexts, depth, bits).places:
                p[here] = n_of[row] / total_of[c] + back_of[c] * p[here]
            done.append(score(batch, counts, p[place]))
        return pa.Table.from_batches(done) if done else empty

    sent = texts.groupBy("block").applyInArrow(ask, asks)
    known = tree.counts.withColumn("v", F.col("n"))
    rows = _by_parts(sent, known, tree.heavy, bits, answer, depth, "block long, piece int, part int, n binary")
    return texts.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(meet, schema)


def _with_table(rows: DataFrame, lower: DataFrame | None, root: float, depth: int) -> DataFrame:
    """``_sum_part`` of each part with the whole table ``lower``, if there is one."""
    shared = lower and rows.sparkSession.sparkContext.broadcast(_index(lower.select("key", "v")))

    def run(packed: pa.Table) -> pa.Table:
        return _sum_part(packed, shared and shared.value, depth, root)

    return rows.groupBy("part").applyInArrow(run, SUMMED)


def learn_tree(
    texts: DataFrame, root: float, depth: int = DEPTH, least_context: int = LEAST_CONTEXT, least_gain: float = LEAST_GAIN, most: int = BROADCAST_KEYS
) -> Tree:
    """From (block, symbols) of all training texts; a pass over them for each depth."""
    texts = texts.select("block", "symbols")
    bits = _bits_for(root)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts(whole):
                line, _, place = _symbols(batch)
                key, n = np.unique(line, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    # the ends before texts are counted with those after them, as contexts
    both = durable(texts.mapInArrow(single, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "symbols")
    symbols = both.withColumn("n", F.when(F.col("key") == END, F.expr("n div 2")).otherwise(F.col("n")))
    candidates = symbols.filter(F.col("n") >= least_context)
    none = contexts = texts.sparkSession.createDataFrame([], "key long, total double, back double")
    counts = texts.sparkSession.createDataFrame([], "key long, ctx long, n long")
    lower, n_counts, all_heavy = None, symbols.count(), []
    heavy = _heavy(candidates)  # among contexts of one symbol, then among the suffixes of longer ones
    for d in range(1, depth + 1):
        all_heavy.append(_heavy(candidates))

        def follow(batch: pa.RecordBatch, listed: Index, _: Index, d: int = d, heavy: np.ndarray = heavy) -> pa.RecordBatch:
            line, _, place = _symbols(batch)
            suffix = before = key = inside = line
            for k, inside in _contexts(line, place, d + 1):  # only the last three lengths are held
                suffix, before, key = before, key, k
            here = np.flatnonzero(place & inside)
            ctx = before[here - 1]
            at, n_of = listed.find(ctx), listed.columns["n"]
            some = (at >= 0) & ((n_of[at] if len(n_of) else at) >= least_context)
            here, ctx = here[some], ctx[some]
            key, suffix = key[here], suffix[here - 1]
            del before, inside, place, k, at, some
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
            n, at = np.diff(np.append(first, len(key))), order[first]
            ctx, suffix, after = ctx[at], suffix[at], line[here[at]]
            del key, order, first, here, at
            # rows of a context go where what follows its suffix is; they lie together there
            part = _part_of(suffix, _mix(suffix, after), heavy, bits)
            by = np.argsort(part << np.uint64(64 - bits) | ctx * _M1 >> np.uint64(bits))
            low = n_of[listed.find(after[by])] if d == 1 else np.zeros(0, np.int64)
            return _pack_next(part[by], ctx[by], suffix[by], after[by].astype(np.int64), low, n[by])

        rows = _over_texts(texts, candidates if lower else symbols, none, d - 1, follow, PACKED, most)
        if lower is None or n_counts + contexts.count() <= most // COUNTS_SHARE:
            sums = _with_table(rows, lower, root, d - 1)
        else:
            sums = _by_parts(rows, lower, heavy, bits, partial(_sum_part, root=root), d - 1, SUMMED)
        found = durable(sums, "follow")
        heavy = all_heavy[-1]
        m = candidates.select(F.col("key").alias("ctx"), F.col("n").alias("m"))
        stats = found.groupBy("ctx").agg(
            F.sum("n").alias("k"), F.count("*").alias("t"), F.sum(F.col("n") * (F.log("n") + F.rint(-100 * F.log("low")) / 100)).alias("g")
        )
        stats = stats.join(m, "ctx").withColumn("once", F.greatest(F.lit(0), F.col("m") - F.col("k")))
        stats = stats.withColumn("total", (F.col("k") + 2 * F.col("once") + F.col("t")).cast("double"))
        stats = stats.withColumn("back", (2 * F.col("once") + F.col("t")) / F.col("total"))
        gain = F.col("g") - F.col("k") * F.log("total") + F.col("once") * F.log("back")
        kept = durable(stats.filter(gain >= least_gain + F.col("t")).select("ctx", "total", "back"), "contexts")
        contexts = contexts.union(kept.select(F.col("ctx").alias("key"), "total", "back"))
        some = F.broadcast(kept) if kept.count() <= min(most, KEPT_ROWS) else kept
        if d < depth:
            v = F.when(F.col("total").isNotNull(), F.col("n") / F.col("total") + F.col("back") * F.col("low")).otherwise(F.col("low"))
            all_next = found.join(some, "ctx", "left").select("key", "ctx", "n", v.alias("v"), F.col("total").isNotNull().alias("used"))
            lower = durable(all_next, "counts")
            counts = counts.union(lower.filter("used").select("key", "ctx", "n"))
            candidates = lower.filter(F.col("n") >= least_context).select("key", "n")
            n_counts += lower.count()
        else:
            counts = counts.union(durable(found.join(some.select("ctx"), "ctx", "left_semi").select("key", "ctx", "n"), "counts"))
        del rows, sums, stats
        forget(found)
        forget_shuffles(texts.sparkSession)
        if d < depth and candidates.isEmpty():
            break
    return Tree(symbols, counts, contexts, np.unique(np.concatenate(all_heavy)), root)


def score_documents(docs: DataFrame, depth: int = DEPTH, own_count: int = OWN_COUNT, least_context: int = LEAST_CONTEXT, most: int = BROADCAST_KEYS) -> DataFrame:
    """Rows (doc_id, held_out, text) to doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. ``base_score`` is the log10 probability by counts of tokens with one
    added; ``score`` is the model's.
    """
    blocks = code_blocks(docs)
    words = count_words(blocks, own_count)
    one = words.filter("first")
    seen = (F.col("c") > 0).cast("long")
    small = F.col("c") < own_count
    by_ending = one.filter(small).groupBy("ending").agg(F.sum(F.col("c") + seen).alias("mass"), F.sum("c").alias("n"), F.sum(seen).alias("v")).collect()
    own = one.filter(~small).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = blocks.filter("word is null and not held_out").count()
    train = sum(r["n"] for r in by_ending) + own["n"] + ends
    distinct = sum(r["v"] for r in by_ending) + own["v"] + (ends > 0)
    log_mass = np.zeros(ENDINGS)
    for r in by_ending:  # at most ENDINGS rows
        log_mass[r["ending"]] = np.log10(r["mass"] + 1)

    def count(texts: pa.Table, counted: pa.Table) -> pa.Table:
        raw = texts.column("codes").to_pylist()
        flat = unpack(np.frombuffer(b"".join(raw), np.uint8))
        lengths = np.array([np.count_nonzero(np.frombuffer(x, np.uint8) < 128) for x in raw], np.int64)
        at, found = counted.column("code").to_numpy(), counted.column("symbol").to_numpy()
        c = np.zeros(1 + at.max(initial=0), np.int64)
        symbol = np.zeros(len(c), np.int64)
        c[at], symbol[at] = counted.column("c").to_numpy(), found
        if named.value is not None:
            own_words = c >= own_count
            symbol[own_words] = named.value.columns["symbol"][named.value.find(symbol[own_words].view(np.uint64))]
        of_word = np.where(c >= own_count, 0.0, np.log10(c + 1.0) - log_mass[np.where(c >= own_count, 0, symbol >> 1)])
        mine = c[flat]
        packed, size = pack(symbol[flat])
        ends, packed = bounds(sums_by_row(size, lengths)).tolist(), packed.tobytes()
        shown = pa.array([packed[a:b] for a, b in zip(ends, ends[1:], strict=False)], pa.binary())
        return pa.table([
            texts.column("block"), texts.column("doc_id"), texts.column("held_out"), pa.array(sums_by_row((mine > 0).astype(np.int64), lengths)),
            pa.array(sums_by_row(np.log10(mine + 1.0), lengths)), pa.array(sums_by_row(of_word[flat], lengths)), shown,
        ], names=[f.split()[0] for f in SUMS.split(", ")])

    rows = blocks.filter("word is null").select("block", "doc_id", "held_out", "codes")
    back, own_symbols = symbols_of(words, most)
    named = docs.sparkSession.sparkContext.broadcast(own_symbols)
    sums = durable(rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(count, SUMS), "sums")
    del rows, back, one
    forget(blocks)
    forget(words)
    forget_shuffles(docs.sparkSession)
    root = float(train + own["v"] + ENDINGS + 1)
    tree = learn_tree(sums.filter("not held_out"), root, depth, least_context, most=most)
    log_base, known_end = float(np.log10(train + distinct + 1)), int(ends > 0)

    def score(batch: pa.RecordBatch, counts: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        found = sums_by_row(np.log10(p), counts) + batch.column("log_words").to_numpy()
        base = batch.column("log_counts").to_numpy() + np.log10(ends + 1) - counts * log_base
        n = len(counts)
        known = pa.array(batch.column("n_known").to_numpy() + known_end)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(counts), known, pa.array(np.full(n, train), pa.int64()), pa.array(base), pa.array(found)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def look_up(batch: pa.RecordBatch, counted: Index, kept: Index) -> pa.RecordBatch:
        line, counts, place = _symbols(batch)
        return score(batch, counts, _shorter(line, place, counted, kept, root, depth)[place])

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    n_counts, n_contexts, n_symbols = tree.counts.count(), tree.contexts.count(), tree.symbols.count()
    if n_counts + n_contexts + n_symbols > most // COUNTS_SHARE and max(n_contexts, n_symbols) <= most:
        return _score_by_parts(sums, tree, n_counts, depth, score, out)
    return _over_texts(sums, tree.symbols.union(tree.counts.select("key", "n")), tree.contexts, depth, look_up, out, most)
