"""Token counts of whole texts under a unigram model, by dynamic programming shared along a trie.

The distinct pre-tokens of a slice of documents form a trie; walked in sorted order it is never held whole. A node's
forward score (the best segmentation of the prefix that it spells, and its number of tokens) is computed once for all
pre-tokens that share the prefix; the counts at terminal nodes are stored and summed per document. No shuffle.

The pieces are those of a public vocabulary. It gives ranks and no probabilities, so a piece of rank r has the
probability of Zipf's law, proportional to 1 / (r + ``RANK_SHIFT``). A sign without a piece costs a token per byte.
A pre-token is a white-space-free run with the word mark in front. Of equal scores the one with fewer tokens counts.

Nulls: a null text is empty and has no tokens; a null doc_id is kept. Repeated rows are counted each. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from placeforge.llm.words import slices, split_words, sums_by_row, texts_of

WORD_MARK = "▁"
RANK_SHIFT = 10
COUNTS = "doc_id long, n_words long, n_distinct long, n_tokens long"


@lru_cache(maxsize=2)
def load_pieces(path: str) -> tuple[dict[str, float], float]:
    """(log probability by piece, log probability of one byte of a sign without a piece)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    whole = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranks = {model.id_to_piece(i): -model.get_score(i) for i in whole}
    total = math.log(sum(1 / (r + RANK_SHIFT) for r in ranks.values()))
    scores = {p: -math.log(r + RANK_SHIFT) - total for p, r in ranks.items()}
    return scores, min(scores.values()) - 1.0


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_words(words: list[str], pieces: dict[str, float], per_byte: float) -> np.ndarray:
    """Tokens in the best segmentation of each of the distinct ``words``, in their order."""
    longest = max(map(len, pieces), default=1)
    found = np.zeros(len(words), np.int64)
    get = pieces.get
    score, tokens = [0.0], [0]  # forward values along the current path of the trie
    before = ""
    for w in sorted(range(len(words)), key=words.__getitem__):
        text = WORD_MARK + words[w]
        shared = len(os.path.commonprefix((before, text)))
        del score[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(text) + 1):
            best, least = -math.inf, 0
            for start in range(max(0, end - longest), end):
                step = get(text[start:end])
                if step is not None:
                    value = score[start] + step
                    if value > best or value == best and tokens[start] < least:
                        best, least = value, tokens[start] + 1
            if text[end - 1] not in pieces:
                n = len(text[end - 1].encode())
                value = score[end - 1] + n * per_byte
                if value > best:
                    best, least = value, tokens[end - 1] + n
            score.append(best)
            tokens.append(least)
        found[w] = tokens[-1]
        before = text
    return found


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_distinct, n_tokens) per document; ``n_distinct`` is the number of different words."""
    path = path or default_pieces()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, per_byte = load_pieces(path)
        for rows, texts in slices(batches):
            counts, codes, words = split_words(texts)
            per_word = count_words(words.to_pylist(), pieces, per_byte)
            row = np.repeat(np.arange(len(counts)), counts)
            different = np.bincount(np.unique(row * len(words) + codes) // max(1, len(words)), minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(counts), pa.array(different.astype(np.int64)), pa.array(sums_by_row(per_word[codes], counts))],
                ["doc_id", "n_words", "n_distinct", "n_tokens"],
            )

    return texts_of(docs).mapInArrow(count, COUNTS)
