"""Whole texts as words, in Arrow batches inside tasks.

Texts are cut at ASCII white space (space and 0x09 to 0x0D) and the words of a slice of documents are
dictionary-encoded, so that Python work is done once per distinct word and the rest is done on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 12_000_000  # bytes of text that a task works on at once; a longer text is a slice of its own


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_CHARS) -> Iterator[tuple]:
    """(rows, texts) with at most ``most`` bytes of text or a single row; null texts become empty."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, last - first), pc.fill_null(text.slice(first, last - first), "")
            first = last


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(words per text, code of every word, distinct words by code) of an array without nulls."""
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    counts = np.diff(parts.offsets.to_numpy()).astype(np.int64)
    encoded = parts.flatten().dictionary_encode()
    codes, words = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    blank = pc.index(words, "").as_py()
    if blank >= 0:  # a text without words is one empty word to the splitter
        kept = codes != blank
        counts = sums_by_row(kept.astype(np.int64), counts)
        codes = codes[kept]
    return counts, codes, words


def bounds(counts: np.ndarray) -> np.ndarray:
    """Where each row starts, and where the last ends."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def sums_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each row's values; rows lie one after the other."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    at = bounds(counts)
    return total[at[1:]] - total[at[:-1]]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i] : starts[i] + lengths[i]]`` one after the other."""
    before = bounds(lengths)
    return flat[np.arange(before[-1]) + np.repeat(starts - before[:-1], lengths)]


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds(counts), pa.int32()), pa.array(values, kind))


def id_remainder(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def texts_of(docs: DataFrame) -> DataFrame:
    """Only the id and the text, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
