"""Token ids of whole texts by the tokenizers library, once per distinct word of a slice.

The tokenizers used here cut at white space before anything else, so a text's ids are its words' ids one after
the other. Distinct words are encoded in bulk, parted by a control character that is a token of its own.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from placeforge.llm.words import bounds, gather, split_words, sums_by_row

MARK = "\x01"
WORDS_PER_CALL = 1000
#: words whose ids a worker keeps from slice to slice, about 200 bytes each; a slice's first words are its most frequent ones
KNOWN_WORDS = 1 << 17
#: ASCII signs that, after a letter or a digit, start a token of their own in any case
ENDINGS = ".,!?;:*#$%&|"
#: letters that are their own lower case and canonical form
PLAIN = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+$"
#: byte-level vocabularies show each byte as a printable sign: the byte's own one, or the next free one from 256 on
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512), strict=False))


def default_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark shares out the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def known_words(path: str) -> dict[str, bytes]:
    """Ids (native 32-bit integers) of words of letters that this worker has met, at most ``KNOWN_WORDS``."""
    return {}


def _encode_plain(words: list[str], tokenizer, mark: int) -> tuple[np.ndarray, np.ndarray]:
    ids, lengths = [], []
    for first in range(0, len(words), WORDS_PER_CALL):
        some = words[first : first + WORDS_PER_CALL]
        found = np.array(
            tokenizer.encode_batch_fast([f" {MARK} ".join(some)], add_special_tokens=False)[0].ids, dtype=np.int32
        )
        marks = np.flatnonzero(found == mark)
        edges = np.concatenate([[-1], marks, [len(found)]])
        lengths.append(np.diff(edges) - 1)
        ids.append(np.delete(found, marks))
    return np.concatenate(ids or [np.zeros(0, np.int32)]), np.concatenate(lengths or [np.zeros(0, np.int64)])


def _encode_words(words: pa.Array, tokenizer, known: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, ids per word)."""
    plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
    odd = pc.match_substring(words, MARK).to_numpy(zero_copy_only=False)
    mark = tokenizer.encode(MARK, add_special_tokens=False).ids
    texts = words.to_pylist()
    ids: list[np.ndarray] = []
    lengths = np.zeros(len(texts), np.int64)
    places: list[np.ndarray] = []

    def add(where: np.ndarray, found: np.ndarray, counts: np.ndarray) -> None:
        places.append(where)
        lengths[where] = counts
        ids.append(found)

    where = np.flatnonzero(plain)
    tokenize = tokenizer.model.tokenize
    # letters only: one pre-token, so the model is asked without the steps before it
    shown = lambda w: w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_SIGNS)
    each = []
    for i in where.tolist():
        word = texts[i]
        found = known.get(word)
        if found is None:
            found = array("i", [t.id for t in tokenize(shown(word))]).tobytes()
            if len(known) < KNOWN_WORDS:
                known[word] = found
        each.append(found)
    add(where, np.frombuffer(b"".join(each), np.int32), np.fromiter(map(len, each), np.int64, len(each)) // 4)
    simple = len(mark) == 1
    where = np.flatnonzero(~plain & ~odd) if simple else np.zeros(0, np.int64)
    if len(where):
        add(where, *_encode_plain([texts[i] for i in where.tolist()], tokenizer, mark[0]))
    where = np.flatnonzero(~plain & odd) if simple else np.flatnonzero(~plain)
    each = [e.ids for e in tokenizer.encode_batch_fast([texts[i] for i in where.tolist()], add_special_tokens=False)]
    add(where, np.fromiter((i for e in each for i in e), np.int32), np.fromiter(map(len, each), np.int64, len(each)))
    order = np.concatenate(places)
    starts = np.empty(len(texts), np.int64)
    starts[order] = bounds(lengths[order])[:-1]
    return gather(np.concatenate(ids), starts, lengths), lengths


def _two_parts(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word as (body, ending); the ending is empty unless it surely is a token of its own."""
    body = pc.utf8_rtrim(words, characters=ENDINGS)
    apart = pc.and_(pc.less(pc.binary_length(body), pc.binary_length(words)), pc.match_substring_regex(body, r"[\p{L}\p{N}]$"))
    some, cut = words.filter(apart).cast(pa.binary()).to_pylist(), pc.binary_length(body.filter(apart)).to_pylist()
    ends = pa.array([w[c:].decode() for w, c in zip(some, cut, strict=True)], pa.string())
    return pc.if_else(apart, body, words), pc.replace_with_mask(pa.array([""] * len(words), pa.string()), apart, ends)


def _folded(words: pa.Array, tokenizer) -> pa.Array:
    """Words with A-Z lower-cased, as the tokenizer does it itself, but for words that hold an added token in any case:
    added tokens are found in a text as it stands, so other forms of them must stay what they are."""
    lower = pc.ascii_lower(words)
    for token in tokenizer.get_added_tokens_decoder().values():
        lower = pc.if_else(pc.match_substring(words, token.content, ignore_case=True), words, lower)
    return lower


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, ids per text), without special tokens."""
    tokenizer = load_tokenizer(path)
    counts, codes, words = split_words(texts)
    body, ending = (part.dictionary_encode() for part in _two_parts(_folded(words, tokenizer)))
    pieces = pa.concat_arrays([body.dictionary, ending.dictionary])
    ids, lengths = _encode_words(pieces, tokenizer, known_words(path))
    starts = bounds(lengths)[:-1]
    first = body.indices.to_numpy(zero_copy_only=False)[codes]
    second = ending.indices.to_numpy(zero_copy_only=False)[codes] + len(body.dictionary)
    parts = np.column_stack([first, second]).ravel()
    per_part = lengths[parts]
    per_text = sums_by_row(sums_by_row(per_part, np.full(len(codes), 2)), counts)
    return gather(ids, starts[parts], per_part), per_text


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text followed by ``end_id``."""
    return np.insert(ids, bounds(lengths)[1:], end_id).astype(np.int32), lengths + 1
