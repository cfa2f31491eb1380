"""Benchmark items in documents, as they are and with other numbers, names and units, by windows of words.

Words lose the signs around them and their case. Windows of ``WINDOW`` words of items and documents meet by hash, in two kinds.
A literal window holds the words as they are. In a template window numbers, units after numbers and names (a capital inside a
sentence) are typed placeholders; windows on one diagonal (place in the document less place in the item) must fill the item's slots
consistently: each filler of the item stands for one filler of the document. If it meets several, it stands for the one at most
of its places, of equals for itself; windows that say otherwise do not count. If neither decides, no template window with this
filler counts, nor one in which another filler stands for one of those it met.

An item's own windows are, of each kind, those that the fewest items hold: a line of instructions that many items begin with
is no item's own, while all windows of an item that is there several times are. A document holds an item if its literal and
consistent own windows cover half of the words that are under own windows in the item, or ``LONG`` of them. Only own
windows bring documents and items together; the other windows are looked up for the pairs found. Hot windows are spread.

Very long texts are cut into windows whole, as any other. An item of fewer words than a window is one window of its own length. A template window needs ``LEAST_PLAIN`` words that are
no placeholders, or half of its words if it is short, to count; a literal one counts whatever its words are.

Nulls: a null text is empty and holds nothing, as does an empty item; null ids are kept, and rows with one id count as one
document (or item). Repeated rows so change nothing. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.llm.words import bounds, slices, split_words, sums_by_row
from placeforge.operators.skew import spread_join
from placeforge.session import durable

WINDOW = 8
LEAST_PLAIN = 4
LONG = 13
SHARE = 0.5
BROADCAST_WINDOWS = 300_000  # item windows are broadcast up to this number of rows, and joined by shuffle beyond
TABLE_BITS = 24
BREAK = "\x02"
TEMPLATE, LITERAL = 0, 1 << 32  # kinds of windows, as their hashes start
NUMBER, UNIT, NAME = (np.uint64(k) for k in (0x51ED270B7F2B6A01, 0x7A3C9D1E5B8F4C03, 0x1D8E4E27C47D1205))
_PRIME = np.uint64(0x9E3779B97F4A7C15)

# fixed values: units of measure that may follow a number
UNITS = frozenset(
    "mm cm dm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres kilometer kilometers "
    "kilometre kilometres g kg mg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces "
    "s sec min h hr second seconds minute minutes hour hours day days week weeks month months year years ml cl l liter "
    "liters litre litres gallon gallons percent dollar dollars euro euros cent cents degree degrees kmh mph w kw v a hz".split()
)


def template(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template words per text, hash of each, filler of each: 0 for a plain word, hash of the word itself) of an array without nulls."""
    counts, codes, words = split_words(pc.replace_substring(texts, "\n", f" {BREAK} "))
    core = pc.replace_substring_regex(words, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    lower = pc.utf8_lower(core)
    low = lower.to_pylist()
    as_array = lambda x: x.to_numpy(zero_copy_only=False)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) | 1 for w in low), np.uint64, len(low))
    empty = as_array(pc.equal(pc.binary_length(core), 0))
    number = as_array(pc.match_substring_regex(core, r"^\d[\d.,:/]*(\p{L}{1,3})?$"))
    capital = as_array(pc.match_substring_regex(core, r"^\p{Lu}[\p{Ll}\p{M}'’-]+$"))
    unit = np.fromiter((w in UNITS for w in low), bool, len(low))
    closing = as_array(pc.match_substring_regex(words, r"[.!?:\x02][\"'”’)\]]*$"))
    n = len(codes)
    row = np.repeat(np.arange(len(counts)), counts)
    # the last word or break before each place: what stands between are bare signs
    solid = ~empty[codes] | closing[codes]
    last = np.maximum.accumulate(np.where(solid, np.arange(n), -1))
    before = np.concatenate([[-1], last[:-1]])[:n]
    opens = (before < 0) | (row[before] != row) | closing[codes[before]] if n else np.zeros(0, bool)
    kept = ~empty[codes]
    codes, row, opens = codes[kept], row[kept], opens[kept]
    is_number = number[codes]
    after_number = np.zeros(len(codes), bool)
    after_number[1:] = is_number[:-1] & (row[1:] == row[:-1])
    is_unit = unit[codes] & after_number
    is_name = capital[codes] & ~opens & ~is_unit
    symbol = np.where(is_number, NUMBER, np.where(is_unit, UNIT, np.where(is_name, NAME, hashed[codes])))
    filler = np.where(is_number | is_unit | is_name, hashed[codes], np.uint64(0))
    return np.bincount(row, minlength=len(counts)).astype(np.int64), symbol, filler, hashed[codes]


def _hashes(symbol: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Hash of every window of ``n`` of at least as many symbols."""
    last = len(symbol) - n + 1
    value = np.full(last, n + kind, np.uint64)
    for k in range(n):
        value = (value ^ symbol[k : k + last]) * _PRIME
        value ^= value >> np.uint64(31)
    return value


def _windows(counts: np.ndarray, symbol: np.ndarray, filler: np.ndarray, raw: np.ndarray, n: int) -> list[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(n, first places, hashes, whether literal) of the windows of ``n`` words inside a text: all literal ones, and the
    template ones with a slot and enough plain words. Without a slot both kinds would be the same."""
    if len(symbol) < n:
        return []
    last = len(symbol) - n + 1
    row = np.repeat(np.arange(len(counts)), counts)
    plain = np.concatenate([[0], np.cumsum(filler == 0)])
    inside, many = row[:last] == row[n - 1 :], plain[n:] - plain[:-n]
    slotted = inside & (many < n) & (many >= min(LEAST_PLAIN, -(-n // 2)))
    return [
        (n, np.flatnonzero(inside), _hashes(raw, n, LITERAL)[inside], True),
        (n, np.flatnonzero(slotted), _hashes(symbol, n, TEMPLATE)[slotted], False),
    ]


WINDOWS = "id long, length long, hash array<long>, place array<int>, n array<int>, slots array<array<int>>, fillers array<array<long>>"


def _window_rows(ids: pa.Array, counts: np.ndarray, filler: np.ndarray, found: list[tuple]) -> pa.RecordBatch:
    """A row for each text with a window; ``found`` are (n, first places, hashes, whether literal). A literal window has no fillers."""
    n = np.concatenate([np.full(len(p), k, np.int32) for k, p, _, _ in found] or [np.zeros(0, np.int32)])
    place = np.concatenate([p for _, p, _, _ in found] or [np.zeros(0, np.int64)])
    value = np.concatenate([h for _, _, h, _ in found] or [np.zeros(0, np.uint64)])
    literal = np.concatenate([np.full(len(p), x) for _, p, _, x in found] or [np.zeros(0, bool)])
    at = bounds(counts)
    row = np.searchsorted(at, place, side="right") - 1
    order = np.lexsort((place, row))
    n, place, value, row, literal = n[order], place[order], value[order], row[order], literal[order]
    slots = np.concatenate([[0], np.cumsum(filler != 0)])
    of_slot = filler[filler != 0].view(np.int64)
    where = (np.arange(len(filler)) - np.repeat(at[:-1], counts))[filler != 0].astype(np.int32)
    begin, many = slots[place], np.where(literal, 0, slots[place + n] - slots[place])
    taken = np.arange(many.sum()) + np.repeat(begin - bounds(many)[:-1], many)
    inner = [pa.ListArray.from_arrays(pa.array(bounds(many), pa.int32()), pa.array(x[taken])) for x in (where, of_slot)]
    rows, per_row = np.unique(row, return_counts=True)
    offsets = pa.array(bounds(per_row), pa.int32())
    lists = [pa.array(value.view(np.int64)), pa.array((place - at[row]).astype(np.int32)), pa.array(n), *inner]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(rows)), pa.array(counts[rows]), *(pa.ListArray.from_arrays(offsets, x) for x in lists)],
        ["id", "length", "hash", "place", "n", "slots", "fillers"],
    )


def _exploded(rows: DataFrame) -> DataFrame:
    one = rows.select("id", "length", F.explode(F.arrays_zip("hash", "place", "n", "slots", "fillers")).alias("w"))
    return one.select("id", "length", "w.hash", "w.place", "w.n", "w.slots", "w.fillers")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, length, hash, place, n, slots, fillers) of all windows of the rows (id, text), written."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            counts, symbol, filler, raw = template(texts)
            found = _windows(counts, symbol, filler, raw, window)
            at = bounds(counts)
            for k in sorted(set(counts[(counts > 0) & (counts < window)].tolist())):
                for n, place, value, literal in _windows(counts, symbol, filler, raw, k):
                    own = counts[np.searchsorted(at, place, side="right") - 1] == n
                    found.append((n, place[own], value[own], literal))
            yield _window_rows(rows.column(0), counts, filler, found)

    return durable(_exploded(items.select("id", "text").mapInArrow(cut, WINDOWS)), "item_windows")


def own_windows(windows: DataFrame) -> DataFrame:
    """The rows of ``item_windows`` with ``own``: no other window of its kind in the item is held by fewer items; and with
    ``own_length``, the item's words under own windows."""
    who = F.struct("id")  # a null id is an item as well
    holders = windows.groupBy("hash", "n").agg(F.count_distinct(who).alias("holders"))
    literal = F.size("slots") == 0  # a template window has a slot
    met = windows.join(holders, ["hash", "n"])
    least = F.min("holders").over(W.partitionBy("id", literal))
    marked = durable(met.withColumn("own", F.col("holders") == least).select(*windows.columns, "own"), "own_windows")
    places = F.array_sort(F.collect_set(F.struct("place", "n")))
    lengths = marked.filter("own").groupBy(F.col("id").alias("_id")).agg(_covered(places).alias("own_length"))
    return durable(marked.join(lengths, F.col("id").eqNullSafe(F.col("_id"))).drop("_id"), "own_windows")


def _covered(places: Column) -> Column:
    """Words under sorted windows (place, n): each adds what lies beyond the furthest end so far."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    return F.aggregate(
        places, start,
        lambda a, w: F.struct(
            F.greatest(a["end"], w["place"] + w["n"]).alias("end"),
            (a["sum"] + F.greatest(F.lit(0), w["place"] + w["n"] - F.greatest(a["end"], w["place"]))).alias("sum"),
        ),
    )["sum"].cast("long")


def document_windows(docs: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of the rows (id, text) whose hashes may be those of an item.

    A bit table of bounded size, filled from all item windows, keeps most others out of the join.
    """
    bits = np.zeros(1 << TABLE_BITS >> 3, np.uint8)
    mark = F.col("hash").bitwiseAND((1 << TABLE_BITS) - 1)
    set_bits = windows.select(mark.alias("b")).distinct().toArrow().column("b").to_numpy()  # at most 2 ** TABLE_BITS
    np.bitwise_or.at(bits, set_bits >> 3, (1 << (set_bits & 7)).astype(np.uint8))
    lengths = sorted({r["n"] for r in windows.select("n").distinct().collect()})  # at most ``window``

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            counts, symbol, filler, raw = template(texts)
            found = []
            for k in lengths:
                for n, place, value, literal in _windows(counts, symbol, filler, raw, k):
                    b = (value & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
                    hit = (bits[b >> 3] >> (b & 7)) & 1 == 1
                    found.append((n, place[hit], value[hit], literal))
            yield _window_rows(rows.column(0), counts, filler, found)

    return _exploded(docs.select("id", "text").mapInArrow(cut, WINDOWS))


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, share: float = SHARE, long: int = LONG, key: str = "doc_id", item_key: str = "item_id"
) -> DataFrame:
    """(key, item key, item_words, covered, coverage, changed_slots): the documents that hold an item.

    ``changed_slots`` is the number of the item's fillers that stand for another filler in the document.
    """
    as_rows = lambda t, k: t.select(F.col(k).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    windows = own_windows(item_windows(as_rows(items, item_key), window))
    mine = document_windows(as_rows(docs, key), windows, window).select(
        F.col("id").alias("doc"), F.col("place").alias("at"), F.col("hash").alias("h"), F.col("n").alias("k"), F.col("fillers").alias("mine")
    )
    mine = durable(mine, "document_windows")
    small = windows.count() <= BROADCAST_WINDOWS
    theirs = windows.withColumn("h", F.col("hash")).withColumn("k", F.col("n"))
    own = theirs.filter("own")
    if small:
        found = mine.join(F.broadcast(own), ["h", "k"])
    else:
        found = spread_join(mine, own, ["h", "k"], F.struct("doc", "at"))
    met = found.select(F.col("doc").alias("_doc"), F.col("id").alias("_id")).distinct()
    rows = mine.join(met, F.col("doc").eqNullSafe(F.col("_doc"))).drop("_doc")
    if small:
        both = rows.join(F.broadcast(theirs), ["h", "k"]).filter(F.col("id").eqNullSafe(F.col("_id")))
    else:  # many items: a window's rows are told apart by the item
        other = theirs.withColumnRenamed("h", "_h").withColumnRenamed("k", "_k")
        both = rows.join(other, (F.col("h") == F.col("_h")) & (F.col("k") == F.col("_k")) & F.col("id").eqNullSafe(F.col("_id")))
    pairs = F.arrays_zip(F.col("slots").alias("s"), F.col("fillers").alias("i"), F.col("mine").alias("d"))
    lines = both.groupBy("doc", "id", "length", "own_length", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set(F.struct("place", "n", "own", pairs.alias("pairs"))).alias("windows")
    )
    lines = lines.withColumn("pairs", F.array_distinct(F.flatten("windows.pairs")))  # one for each place with a slot
    lines = lines.withColumn("links", F.array_distinct(F.transform("pairs", lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d")))))
    clear = F.size("links") == F.size(F.array_distinct("links.i"))
    # conflicts: places of each link, and half a place for a filler that stands for itself
    votes = F.transform("links", lambda x: F.struct(
        x["i"].alias("i"), x["d"].alias("d"),
        (F.size(F.filter("pairs", lambda p: (p["i"] == x["i"]) & (p["d"] == x["d"]))) * 2 + (x["i"] == x["d"]).cast("int")).alias("v"),
    ))
    lines = lines.withColumn("votes", F.when(~clear, votes))
    chosen = F.filter("votes", lambda x: F.forall("votes", lambda o: (o["i"] != x["i"]) | (o["d"] == x["d"]) | (o["v"] < x["v"])))
    lines = lines.withColumn("chosen", chosen)
    open_links = F.filter("votes", lambda x: ~F.array_contains(F.col("chosen.i"), x["i"]))
    lines = lines.withColumn("open", F.transform(open_links, lambda x: x["d"]))
    sure = F.filter("chosen", lambda x: ~F.array_contains(F.col("open"), x["d"]))
    sure = F.transform(sure, lambda x: F.struct(x["i"].alias("i"), x["d"].alias("d")))
    lines = lines.withColumn("sure", F.when(clear, F.col("links")).otherwise(sure))
    agreeing = F.filter("windows", lambda w: F.forall(w["pairs"], lambda p: F.array_contains(F.col("sure"), F.struct(p["i"].alias("i"), p["d"].alias("d")))))
    lines = lines.select("doc", "id", "length", "own_length", F.when(clear, F.col("windows")).otherwise(agreeing).alias("windows")).filter(F.size("windows") > 0)
    changed = F.filter(F.flatten("windows.pairs"), lambda p: p["i"] != p["d"])
    place = lambda w: F.struct(w["place"].alias("place"), w["n"].alias("n"))
    merged = lambda windows: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform(windows, place)))))
    met = lines.groupBy("doc", "id", "length", "own_length").agg(
        merged(F.col("windows")).alias("places"), merged(F.filter("windows", lambda w: w["own"])).alias("own_places"),
        F.max(F.size(F.array_distinct(F.transform(changed, lambda p: p["i"])))).alias("changed_slots"),
    )
    met = met.withColumn("covered", _covered(F.col("places"))).withColumn("own_covered", _covered(F.col("own_places")))
    enough = F.least(F.lit(long).cast("double"), F.col("own_length") * share)
    return met.filter(F.col("own_covered") >= enough).select(
        F.col("doc").alias(key), F.col("id").alias(item_key), F.col("length").alias("item_words"), "covered",
        (F.col("covered") / F.col("length")).alias("coverage"), F.col("changed_slots").cast("long").alias("changed_slots"),
    )
