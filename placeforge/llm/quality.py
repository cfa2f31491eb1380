"""Quality of whole texts by regularised quadratic discriminant analysis.

Each document becomes a row of transformed statistics. Per class the mean and the covariance are summed by Spark over
all labelled rows; the covariance is shrunk towards the classes' common one and towards its own diagonal. A score
compares the two log densities: Mahalanobis distances by the inverse Cholesky factors, which are computed once.

Nulls: a null text is empty; an empty text has a row of statistics like any other and so a score. A label row without
a quality, or for an unknown or null doc_id, teaches nothing; repeated labels or documents count each. If a class has no
labelled row, every text gets the other class (0.5 without any label). Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeforge.llm.words import slices, split_words, sums_by_row, texts_of

THRESHOLD = 0.3  # a document is good from this score on
TO_COMMON = 0.05  # part of the common covariance in a class's own
TO_DIAGONAL = 0.05  # part of the diagonal
LEAST_VARIANCE = 1e-3

_KINDS = ("upper", "lower", "digit", "ending", "sign", "other")
_KIND_OF_BYTE = np.full(256, 5, np.uint8)
for _kind, _signs in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".,;:'\"-()", "#$%&*!|<>=+@/\\^_`{}[]~?")):
    _KIND_OF_BYTE[list(_signs.encode())] = _kind
_KIND_OF_BYTE[[9, 10, 11, 12, 13, 32]] = 6  # white space

STATISTICS = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digit", "ending", "sign", "other",
    "different_words", "top_word", "same_neighbour", "log_lines", "different_lines", "log_words_per_line", "bare_signs",
]


def _by_kind(texts: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Bytes of each kind per text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    kinds = _KIND_OF_BYTE[data]
    return np.column_stack([sums_by_row((kinds == k).astype(np.int32), sizes) for k in range(len(_KINDS))])


def _part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A share on a scale that spreads small ones."""
    return np.log(a / np.maximum(b, 1) + 0.01)


def statistics(texts: pa.Array) -> np.ndarray:
    """(texts, statistics) of an array of strings without nulls."""
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    kinds = _by_kind(texts, sizes)
    counts, codes, words = split_words(texts)
    n = len(sizes)
    row = np.repeat(np.arange(n), counts)
    length = pc.binary_length(words).to_numpy().astype(np.float64)[codes]
    mean = sums_by_row(length, counts) / np.maximum(counts, 1)
    spread = np.sqrt(np.maximum(sums_by_row(length**2, counts) / np.maximum(counts, 1) - mean**2, 0))
    pair, times = np.unique(row * max(1, len(words)) + codes, return_counts=True)
    pair_row = pair // max(1, len(words))
    different = np.bincount(pair_row, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, pair_row, times)
    same = np.zeros(len(codes), np.int64)
    same[1:] = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
    bare = pc.match_substring_regex(words, r"^[^\p{L}\p{N}]+$").to_numpy(zero_copy_only=False)[codes].astype(np.int64)
    lines = pc.split_pattern(texts, "\n")
    n_lines = np.diff(lines.offsets.to_numpy()).astype(np.int64)
    line_row = np.repeat(np.arange(n), n_lines)
    coded = lines.flatten().dictionary_encode()
    n_codes = max(1, len(coded.dictionary))
    own_lines = np.bincount(np.unique(line_row * n_codes + coded.indices.to_numpy(zero_copy_only=False)) // n_codes, minlength=n)
    visible = kinds.sum(axis=1)
    return np.column_stack([
        np.log1p(sizes), np.log1p(counts), mean, np.log1p(spread), _part(kinds[:, 0], visible), _part(kinds[:, 2], visible),
        _part(kinds[:, 3], visible), _part(kinds[:, 4], visible), kinds[:, 5] / np.maximum(visible, 1),
        # a long text has fewer different words: the exponent that the count is of all words
        np.log1p(different) / np.log1p(np.maximum(counts, 1)), _part(top, counts),
        _part(sums_by_row(same, counts), counts), np.log1p(n_lines), _part(own_lines, n_lines),
        np.log1p(counts / np.maximum(n_lines, 1)), _part(sums_by_row(bare, counts), counts),
    ])


def statistics_of(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with the transformed statistics of every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            x = statistics(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], ["doc_id", "x"])

    return texts_of(docs).mapInArrow(compute, "doc_id long, x array<double>")


class Model(NamedTuple):
    log_prior: np.ndarray  # by class
    mean: np.ndarray
    whiten: np.ndarray  # inverse Cholesky factors of the covariances
    log_det: np.ndarray
    only: float | None = None  # the score of every text if a class is missing


def fit(labelled: DataFrame) -> Model:
    """From rows (x, quality) with quality 0 or 1; all of them count."""
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(-1, d)
            y = b.column(1).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()), pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), pa.array(total.ravel())],
            ["c", "place", "value"],
        )

    rows = labelled.filter("quality in (0, 1)").select("x", F.col("quality").cast("int").alias("quality"))
    sums = rows.mapInArrow(moments, "c int, place int, value double").groupBy("c", "place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in sums:  # 2 * (1 + d + d * d) numbers
        total[r["c"], r["place"]] = r["value"]
    n = total[:, 0]
    if not n.all():
        empty = np.zeros((2, d))
        return Model(np.zeros(2), empty, np.zeros((2, d, d)), np.zeros(2), 0.5 if not n.any() else float(n[1] > 0))
    mean = total[:, 1 : 1 + d] / n[:, None]
    scatter = total[:, 1 + d :].reshape(2, d, d) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    common = scatter.sum(axis=0) / n.sum()
    whiten, log_det = np.empty((2, d, d)), np.empty(2)
    for c in (0, 1):
        own = (1 - TO_COMMON) * scatter[c] / n[c] + TO_COMMON * common
        own = (1 - TO_DIAGONAL) * own + TO_DIAGONAL * np.diag(np.diag(own)) + LEAST_VARIANCE * np.eye(d)
        factor = np.linalg.cholesky(own)
        whiten[c], log_det[c] = np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()
    return Model(np.log(n / n.sum()), mean, whiten, log_det)


def scores(x: np.ndarray, model: Model) -> np.ndarray:
    """Probability of class 1 for rows of statistics."""
    if model.only is not None:
        return np.full(len(x), model.only)
    density = [
        model.log_prior[c] - 0.5 * (((x - model.mean[c]) @ model.whiten[c].T) ** 2).sum(axis=1) - 0.5 * model.log_det[c]
        for c in (0, 1)
    ]
    return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def score_documents(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for rows (doc_id, x)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = scores(b.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS)), model)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return stats.select("doc_id", "x").mapInArrow(compute, "doc_id long, score double, predicted int")
