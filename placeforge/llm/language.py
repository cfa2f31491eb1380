"""Language of whole texts, with the spans of mixed ones.

A word's script narrows the candidate languages; its score per language is that of its character n-grams. Viterbi with
a penalty for each switch labels the words. A text is of the language with most letters on the best path.

A path that never switches is best whenever no run of words gains more than one penalty over the best single language in
any other, and no first run and last run gain more than one together: a path that uses the best language has a switch for each
of its other parts, one that never uses it has one switch less than parts, the first and the last among them. That is tested
on arrays for every text; only the texts that fail the test are searched step by step, with the same result.

The model is fitted on a sample of labelled rows, about ``SAMPLE_PER_LANG`` for each language, drawn by a hash of
the id, whole texts; it keeps at most ``GRAMS_PER_LANG`` n-grams for each language.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows without text or language teach nothing. A
null doc_id is kept; repeated rows are labelled each. Without any labelled row every text is ``und``. Empty tables give
no rows. Other columns are ignored. Equal scores go to the language that is first by name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeforge.llm.words import bounds, slices, split_words, sums_by_row

SAMPLE_PER_LANG = 3000
GRAMS_PER_LANG = 50_000
ORDERS = (1, 2, 3)
PENALTY = 8.0  # natural log units a switch costs
OUT_OF_SCRIPT = -12.0
MIN_SCRIPT_SHARE = 0.01  # a language has the scripts that at least this part of its letters' words are in
UNKNOWN = "und"
CELLS = 4_000_000

# fixed values: first code point of a range of letters and the script it belongs to (Unicode blocks, coarse)
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF65, "kana"), (0xFFA0, "hangul"), (0x10000, "other"),
    (0x20000, "han"), (0x30000, "other"),
]
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_KIND = np.array([_NAMES.index(n) for _, n in SCRIPTS])


class Model(NamedTuple):
    languages: list[str]
    grams: dict[str, int]  # row of ``scores``; row 0 is any other n-gram
    scores: np.ndarray  # (n-grams, languages), log
    scripts: np.ndarray  # (scripts, languages), whether the language uses the script


def letters_of(words: pa.Array) -> pa.Array:
    """Lower-case letters of each word, without anything else."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", "")


def scripts_of(words: list[str]) -> np.ndarray:
    """Script of each word's first letter; -1 for an empty word."""
    first = np.array([ord(w[0]) if w else -1 for w in words], dtype=np.int64)
    return np.where(first < 0, -1, _KIND[np.searchsorted(_STARTS, first, side="right") - 1])


def _grams(word: str) -> list[str]:
    framed = f"^{word}$"
    return [framed[i : i + n] for n in ORDERS for i in range(len(framed) - n + 1)]


def fit(labelled: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learns from the columns ``doc_id, text, lang``; see the module's text for the bound of the sample."""
    known = labelled.filter("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / F.lit(1_000_000)
    share = F.create_map([F.lit(x) for k, n in sizes.items() for x in (k, sample_per_lang / n)]) if sizes else None
    sample = known.filter(drawn < share[F.col("lang")]) if sizes else known.limit(0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, most=4_000_000):
            out: Counter = Counter()
            langs = np.array(rows.column(1).to_pylist())
            for lang in sorted(set(langs.tolist())):
                _, codes, words = split_words(texts.filter(pa.array(langs == lang)))
                times, plain = np.bincount(codes, minlength=len(words)).tolist(), letters_of(words).to_pylist()
                for word, n, script in zip(plain, times, scripts_of(plain).tolist(), strict=True):
                    if word:
                        out[lang, f"#{_NAMES[script]}"] += n
                        for g in _grams(word):
                            out[lang, f"={g}"] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array(list(out.values()), pa.int64())],
                ["lang", "gram", "n"],
            )

    counts = sample.select("text", "lang").mapInArrow(count, "lang string, gram string, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter("n > 1 or gram like '#%'")
    # the sample is bounded, so a language's n-grams may meet in a task
    best = counts.withColumn("_r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    found = best.filter(F.col("_r") <= GRAMS_PER_LANG).select("lang", "gram", "n").collect()
    languages = sorted({r["lang"] for r in found})
    names = sorted({r["gram"][1:] for r in found if r["gram"][0] == "="})
    grams = {g: i + 1 for i, g in enumerate(names)}
    table = np.zeros((len(grams) + 1, len(languages)))
    scripts = np.zeros((len(_NAMES), len(languages)))
    for r in found:
        column = languages.index(r["lang"])
        if r["gram"][0] == "#":
            scripts[_NAMES.index(r["gram"][1:]), column] = r["n"]
        else:
            table[grams[r["gram"][1:]], column] = r["n"]
    # frequencies by order of n-gram, one count added; the orders overlap, so each weighs its part
    order = np.array([0, *map(len, names)])
    scores = np.zeros_like(table)
    for n in ORDERS:
        rows = order == n
        scores[rows] = np.log((table[rows] + 0.5) / (table[rows].sum(axis=0) + 0.5 * (rows.sum() + 1))) / len(ORDERS)
    if len(languages):
        scores[0] = scores[1:].min() if len(names) else 0.0
    used = scripts >= MIN_SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    return Model(languages, grams, scores, used)


def word_scores(words: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(score per language of each distinct word, relative to its best one; letters of each word)."""
    encoded = letters_of(words).dictionary_encode()
    plain = encoded.dictionary.to_pylist()
    get = model.grams.get
    rows = [[get(g, 0) for g in _grams(w)] if w else [] for w in plain]
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter((g for r in rows for g in r), np.int64, counts.sum())
    out = np.empty((len(plain), len(model.languages)))
    for lang in range(len(model.languages)):
        out[:, lang] = sums_by_row(model.scores[flat, lang], counts)
    script = scripts_of(plain)
    candidates = model.scripts[np.maximum(script, 0)] | ~model.scripts[np.maximum(script, 0)].any(axis=1, keepdims=True)
    out += np.where(candidates, 0.0, OUT_OF_SCRIPT)
    out -= out.max(axis=1, keepdims=True)
    out[counts == 0] = 0.0  # no letter, no opinion
    of_word = encoded.indices.to_numpy(zero_copy_only=False)
    letters = pc.utf8_length(encoded.dictionary).to_numpy().astype(np.int64)
    return out[of_word], letters[of_word]


def _needs_search(scores: np.ndarray, counts: np.ndarray, best: np.ndarray, penalty: float) -> np.ndarray:
    """Whether a run of a text's words in a language other than ``best``, or its first and last run together, gain more than a penalty."""
    at = bounds(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    found = np.zeros(len(counts), bool)
    first, last = np.zeros(len(counts)), np.zeros(len(counts))
    base = scores[np.arange(len(row)), best[row]] if len(row) else np.zeros(0)
    # the largest gain of a run is the largest rise of the running sum over its lowest point so far in the text
    for lang in range(scores.shape[1]):
        run = np.cumsum(scores[:, lang] - base)
        start = np.concatenate([[0.0], run])[at[:-1]]
        for i in np.flatnonzero(counts):
            part = run[at[i] : at[i + 1]] - start[i]
            low = np.minimum(np.minimum.accumulate(part), 0.0)
            if part[0] > penalty or (part[1:] - low[:-1]).max(initial=-np.inf) > penalty:
                found[i] = True
            first[i] = max(first[i], part.max())
            last[i] = max(last[i], part[-1] - low[-1])
    return found | (first + last > penalty)


def _viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> list[np.ndarray]:
    """Best path of each text, several texts side by side; of equal paths the one that stays, then the first by name."""
    n, steps, langs = len(lengths), int(lengths.max()), scores.shape[1]
    value = np.zeros((n, langs))
    came = np.zeros((steps, n, langs), np.int16)
    for t in range(steps):
        live = np.flatnonzero(lengths > t)
        here = value[live]
        top = here.argmax(axis=1)
        switch = here[np.arange(len(live)), top] - penalty
        moves = switch[:, None] > here
        came[t, live] = np.where(moves & (t > 0), top[:, None], np.arange(langs)[None, :])
        value[live] = (np.where(moves, switch[:, None], here) if t else here) + scores[starts[live] + t]
    paths = []
    for i in range(n):
        path = np.empty(lengths[i], np.int16)
        state = int(value[i].argmax())
        for t in range(lengths[i] - 1, -1, -1):
            path[t] = state
            state = int(came[t, i, state])
        paths.append(path)
    return paths


def label_words(scores: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """(language of every word on the best path, log odds of each text's best single language over the next)."""
    total = np.column_stack([sums_by_row(scores[:, k], counts) for k in range(scores.shape[1])])
    best = total.argmax(axis=1)
    ranked = np.sort(total, axis=1)
    lead = ranked[:, -1] - ranked[:, -2] if total.shape[1] > 1 else np.full(len(counts), 50.0)
    path = np.repeat(best, counts).astype(np.int16)
    at = bounds(counts)
    open_texts = np.flatnonzero(_needs_search(scores, counts, best, penalty))
    open_texts = open_texts[np.argsort(counts[open_texts], kind="stable")]
    first = 0
    while first < len(open_texts):
        last = first + 1
        while last < len(open_texts) and (last + 1 - first) * counts[open_texts[last]] * scores.shape[1] <= CELLS:
            last += 1
        some = open_texts[first:last]
        for i, found in zip(some.tolist(), _viterbi(scores, at[some], counts[some], penalty), strict=True):
            path[at[i] : at[i + 1]] = found
        first = last
    return path, lead


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY, keys: tuple[str, ...] = ("doc_id",), with_spans: bool = False) -> DataFrame:
    """(keys, lang_pred, score[, spans]) of every whole text.

    ``score`` is the part of the letters that the language has on the path, times the odds of the text's best single
    language against the next one. ``spans`` are (lang, first word, number of words).
    """
    rows_in = docs.select(*keys, F.col("text").cast("string").alias("_text"))
    schema = T.StructType([rows_in.schema[k] for k in keys]).add("lang_pred", "string").add("score", "double")
    span = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    if with_spans:
        part = T.StructType().add("lang", "string").add("first_word", "long").add("n_words", "long")
        schema = schema.add("spans", T.ArrayType(part))
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "_text"):
            counts, codes, words = split_words(texts)
            n, langs = len(counts), len(model.languages)
            if langs:
                scores, letters = (x[codes] for x in word_scores(words, model))
                path, lead = label_words(scores, counts, penalty)
            else:
                letters, path, lead = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int16), np.zeros(n)
            row = np.repeat(np.arange(n), counts)
            share = np.bincount(row * max(1, langs) + path, letters, minlength=n * max(1, langs)).reshape(n, -1)
            total, best = share.sum(axis=1), share.argmax(axis=1)
            none = total == 0
            score = share.max(axis=1) / np.maximum(total, 1) / (1 + np.exp(-np.minimum(lead, 50)))
            out = [pa.array(names[np.where(none, langs, best)], pa.string()), pa.array(np.where(none, 0.0, score))]
            if with_spans:
                at, spans = bounds(counts), []
                for i in range(n):
                    own = path[at[i] : at[i + 1]]
                    cuts = [] if none[i] else [0, *(np.flatnonzero(np.diff(own)) + 1).tolist()]
                    ends = [*cuts[1:], len(own)]
                    spans.append([{"lang": names[own[a]], "first_word": a, "n_words": b - a} for a, b in zip(cuts, ends, strict=False)])
                out.append(pa.array(spans, pa.list_(span)))
            kept = [rows.column(i) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays(kept + out, [*keys, "lang_pred", "score"] + ["spans"] * with_spans)

    return rows_in.mapInArrow(label, schema)
