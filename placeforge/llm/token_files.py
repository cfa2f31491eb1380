"""Token files: Parquet with one list of token ids per document, in ascending order of document.

Ids are dictionary-encoded lists, counts and places are delta-encoded, row groups and pages are kept small and
carry the indexes that let a reader fetch a few documents or only the metadata.

Nulls: a null text is empty and gets the end id alone; a null doc_id sorts first. Rows with one doc_id are ordered
by text, repeated rows each have an entry. An empty table gives a folder of empty files. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.llm.tokens import default_tokenizer, encode_texts, with_end
from placeforge.llm.words import bounds, list_array, slices, texts_of

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
FILE_SCHEMA = "file_no int, doc_id long, start_in_file long, n_tokens long, tokens array<int>"

WRITE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding where there is no dictionary
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_file": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}


def crc32_of_ids(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each row's ids as little-endian unsigned 32-bit integers."""
    raw, at = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B"), (bounds(lengths) * 4).tolist()
    return np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:], strict=False)), np.int64, len(lengths))


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encodes whole texts, adds ``end_id`` to each and writes them under ``path`` in order of doc_id.

    Files are numbered in that order (``file_no``); ``start_in_file`` counts the ids before a document there.
    """
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no, start = TaskContext.get().partitionId(), 0
        for rows, texts in slices(batches):
            ids, lengths = with_end(*encode_texts(texts, tokenizer), end_id)
            at = bounds(lengths) + start
            start = int(at[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lengths), file_no), pa.int32()), rows.column(0),
                    pa.array(at[:-1], pa.int64()), pa.array(lengths, pa.int64()), list_array(ids, lengths, pa.int32()),
                ],
                ["file_no", "doc_id", "start_in_file", "n_tokens", "tokens"],
            )

    # the hash parts rows of one doc_id, should they be many
    rows = texts_of(docs).withColumn("_h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text")
    ordered.select("doc_id", "text").mapInArrow(encode, FILE_SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents with their tokens; filters on doc_id reach the row groups and pages."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) without touching the tokens; ``start`` counts the ids of all documents before."""
    return with_starts(read_token_files(spark, path).drop("tokens")).drop("file_no", "start_in_file")


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the ids in earlier files and earlier in this one."""
    sizes = rows.groupBy("file_no").agg(F.max(F.col("start_in_file") + F.col("n_tokens")).alias("_size"))
    # one row per file: small enough for one task and for a broadcast
    earlier = W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("file_no", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "file_no").withColumn("start", F.col("_before") + F.col("start_in_file")).drop("_before")


def digest(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read_token_files`` gives."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column(3)
            lengths = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
            found = crc32_of_ids(tokens.flatten().to_numpy(zero_copy_only=False), lengths)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(found, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    rows = with_starts(files).select("doc_id", "start", "n_tokens", "tokens")
    return rows.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
