import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placeforge.llm import exact_dedup, packing, token_files, tokens
from placeforge.llm.words import bounds
from tests.llm.tables import documents, odd_texts, words

TOKENIZER = tokens.load_tokenizer(tokens.default_tokenizer())


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_whole_text():
    texts = [t or "" for t in odd_texts()] + ["it's don't 's", "a.b. c'd's", "<|endoftext|> x<|endoftext|>.", "x)., y-. \"q\".", "İx \x1c x\x1fy", "é. ́.", "a,,b;;"]
    for some in (texts, texts[:3], []):
        ids, lengths = tokens.encode_texts(pa.array(some, pa.string()), tokens.default_tokenizer())
        at = bounds(lengths)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [ids_of(t) for t in some]


def test_words_are_encoded_once_for_all_slices_and_kept_up_to_a_bound(monkeypatch):
    path = tokens.default_tokenizer()
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 20)
    tokens.known_words.cache_clear()
    texts = [words(i % 3, 30) + " Été dinner." for i in range(6)]
    for some in (texts[:1], texts, texts[3:]):
        ids, lengths = tokens.encode_texts(pa.array(some, pa.string()), path)
        at = bounds(lengths)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [ids_of(t) for t in some]
        assert len(tokens.known_words(path)) == 20
    for word, found in tokens.known_words(path).items():
        assert np.frombuffer(found, np.int32).tolist() == ids_of(word)
    tokens.known_words.cache_clear()


def test_cuckoo_index_inserts_deletes_and_grows():
    index = exact_dedup.CuckooIndex(buckets=2)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, k in enumerate(keys):
        index.add(k, i, i, 1)
    assert index.live == 3000 and index.mask + 1 >= 1024
    assert all(index.find(k)[1] == i for i, k in enumerate(keys))
    for k in keys[::2]:
        index.add(k, None, 0, -1)
    assert index.live == 1500
    assert [index.find(k) is None for k in keys[:6]] == [True, False] * 3
    index.add(keys[1], 9999, 0, 2)  # a larger id takes the place of the live key
    assert index.find(keys[1])[1:] == [9999, 0, 3]


@pytest.mark.parametrize("held", [2, 200_000])
def test_exact_dedup_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_INDEX", held)
    texts = odd_texts() + ["Same TEXT"] * 40 + ["same text"] * 30 + [words(9, 5)] * 2
    ids = [*range(len(texts) - 3), None, 5, 5]
    found = exact_dedup.duplicate_groups(documents(spark, texts, ids=ids).repartition(7)).collect()
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    digest = lambda t: hashlib.sha256(lower(t).encode()).digest()
    groups = {}
    for i, t in zip(ids, texts, strict=True):
        groups.setdefault(digest(t), []).append(i)
    best = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.digest), r.keep_id, r.group_size) for r in found) == sorted(
        (i is None, i or 0, digest(t), best[digest(t)], len(groups[digest(t)])) for i, t in zip(ids, texts, strict=True)
    )
    kept = [bytes(r.digest) for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_index_goes_on_from_an_earlier_one(spark):
    first = exact_dedup.digests_of(documents(spark, ["a", "b", "b"]))
    index = exact_dedup.live_keys(first)
    more = exact_dedup.digests_of(documents(spark, ["c", "a"], ids=[10, 11]))
    gone = exact_dedup.digests_of(documents(spark, ["b", "b", "c"], ids=[1, 2, 10]))
    after = exact_dedup.live_keys(more, index, gone).collect()
    assert [(r.last_id, r.n) for r in after] == [(11, 2)]


def test_added_tokens_in_all_forms():
    tokenizer = tokens.load_tokenizer(tokens.default_tokenizer())
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    assert added
    texts = []
    for token in added:
        for form in (token, token.upper(), token.title(), token.swapcase(), token[:5] + token[5:].upper()):
            texts += [form, f"A {form} b", f"glued{form}GLUED", form + form, form + ".", f"!{form}?|", form[:-1], form[1:], f"É{form}é", f"{form}\n{token}"]
    ids, counts = tokens.encode_texts(pa.array(texts), tokens.default_tokenizer())
    at = bounds(counts)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_token_files_round_trip(spark, tmp_path):
    texts = odd_texts()
    ids = [*range(len(texts) - 2, 2, -1), None, 3, 3, 900]
    docs = documents(spark, texts, ids=ids)
    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs.repartition(5), path)
    files = token_files.read_token_files(spark, path)
    rows = files.orderBy("file_no", "start_in_file").collect()
    key = lambda i: (i is not None, i or 0)
    assert [key(r.doc_id) for r in rows] == sorted(key(i) for i in ids)
    assert sorted(map(tuple, (r.tokens for r in rows))) == sorted(tuple([*ids_of(t), 1]) for t in texts)
    found = token_files.digest(files).orderBy("start").collect()
    starts = bounds(np.array([len(r.tokens) for r in rows]))
    assert [r.start for r in found] == starts[:-1].tolist()
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(r.tokens, "<u4").tobytes()) for r in rows]
    meta = token_files.read_metadata(spark, path)
    assert set(meta.columns) == {"doc_id", "start", "n_tokens"} and meta.count() == len(texts)
    one = files.filter("doc_id = 900")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,900)]" in one._jdf.queryExecution().toString() and one.count() == 1


def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    token_files.write_token_files(none, str(tmp_path / "none"))
    assert token_files.digest(token_files.read_token_files(spark, str(tmp_path / "none"))).count() == 0


def best_fit_decreasing(lengths, capacity):
    bins, n = [], 0
    for size in sorted(lengths, reverse=True):
        at = bisect.bisect_left(bins, size)
        left = (bins.pop(at) if at < len(bins) else capacity) - size
        n += at == len(bins) and left == capacity - size
        bisect.insort(bins, left)
    return len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = [7, 64, 100, 2048, 50, 1][seed]
    lengths = rng.integers(1, capacity + 1, 400).tolist() + [capacity // 3 + 1] * 200
    counts = {n: lengths.count(n) for n in set(lengths)}
    steps = packing.plan(counts, capacity)
    used = {}
    for s in steps:
        for i in range(s.pieces):
            used.setdefault(s.bin + i // s.each, []).append((s.offset + i % s.each * s.length, s.length))
    assert sum(s.pieces for s in steps) == len(lengths)
    for pieces in used.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    assert len(used) == best_fit_decreasing(lengths, capacity)


def test_packed_sequences_hold_every_token_once(spark):
    texts = odd_texts()
    packed = packing.pack_documents(documents(spark, texts).repartition(3), capacity=64, with_ids=True)
    rows = packed.collect()
    for i, t in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [x for r in own for x in r.ids] == [*ids_of(t), 0]
        assert [r.start for r in own] == [64 * k for k in range(len(own))]
        assert all(r.length == 64 for r in own[:-1])
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
    whole = packing.sequences(packed).collect()
    assert all(len(r.tokens) <= 64 for r in whole)
    assert sum(len(r.tokens) for r in whole) == sum(len(ids_of(t)) + 1 for t in texts)
    assert len(whole) == best_fit_decreasing([r.length for r in rows], 64)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("s")).filter("s > 64").count() == 0
