import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from placeforge.llm import suffix_lm
from placeforge.llm.words import id_remainder, texts_of
from tests.llm.tables import documents, odd_texts, words


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def with_folds(docs):
    return texts_of(docs).withColumn("held_out", id_remainder(7) == 2)


def scored(docs, **options):
    return suffix_lm.score_documents(with_folds(docs), **options)


def is_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute_force(ids, texts, own, least, depth):
    """Scores by dictionaries of whole sequences, all in one place."""
    train = [tokens(t) for i, t in zip(ids, texts, strict=True) if not is_out(i)]
    count = Counter(w for t in train for w in t)
    symbol = lambda w: "END" if w is None else ("own", w) if count[w] >= own else w[-2:]
    n = Counter(symbol(w) for t in train for w in t)
    mass = defaultdict(lambda: 1)
    for w, c in count.items():
        if w is not None and c < own:
            mass[w[-2:]] += c + 1
    root = sum(n.values()) + sum(c >= own for w, c in count.items() if w is not None) + suffix_lm.ENDINGS + 1
    kept, follow = {}, defaultdict(Counter)

    def chance(before, nxt, most):
        p = (n[nxt] + 1) / root
        for d in range(1, min(most, len(before)) + 1):
            ctx = tuple(before[-d:])
            if ctx in kept:
                total, back = kept[ctx]
                p = follow[ctx][nxt] * (follow[ctx][nxt] > 1) / total + back * p
        return p

    for d in range(1, depth + 1):
        found = {}
        for t in train:
            line = ["END", *map(symbol, t)]
            for i in range(d, len(line)):
                follow[tuple(line[i - d : i])][line[i]] += 1
        for ctx in [c for c in follow if len(c) == d and sum(follow[c].values()) >= least]:
            often = {s: c for s, c in follow[ctx].items() if c > 1}
            k, t, once = sum(often.values()), len(often), sum(follow[ctx].values()) - sum(often.values())
            if not often:
                continue
            total, back = k + 2 * once + t, (2 * once + t) / (k + 2 * once + t)
            low = {s: round(-100 * math.log(chance(ctx, s, d - 1))) / 100 for s in often}
            gain = sum(c * (math.log(c / total) + low[s]) for s, c in often.items()) + once * math.log(back)
            if gain >= suffix_lm.LEAST_GAIN + t:
                found[ctx] = (total, back)
        kept |= found
    out = {}
    for i, text in zip(ids, texts, strict=True):
        line, score = ["END"], 0.0
        for w in tokens(text):
            s = symbol(w)
            score += math.log10(chance(line, s, depth)) + (0 if s == "END" or s[0] == "own" else math.log10((count[w] + 1) / mass[s]))
            line.append(s)
        out[i] = score
    return out, kept


def phrases(n, seed=5):
    """Texts of a few phrases between random words, so that there are contexts of several lengths."""
    r = np.random.default_rng(seed)
    some = ["the old man and the sea", "the old house on the hill", "a man of the sea", "on the old road and away"]
    return [" ".join([some[r.integers(4)] + " " + words(int(r.integers(500)), 3) for _ in range(int(r.integers(1, 12)))]) for _ in range(n)]


def test_counts_and_base_against_brute_force(spark):
    texts = odd_texts() + [words(i % 5, 50) + " the end" for i in range(40)]
    ids = [*range(len(texts) - 2), None, 3]
    out = {i: is_out(i) for i in ids}
    counts = Counter(w for i, t in zip(ids, texts, strict=True) if not out[i] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, t in zip(ids, texts, strict=True):
        w = tokens(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        expected.append((i is None, i or 0, out[i], len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)))
    found = scored(documents(spark, texts, ids=ids).repartition(5)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == sorted(expected)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert any(out.values()) and not all(out.values())


def test_scores_against_brute_force_by_broadcast_and_by_blocks(spark):
    texts = [*phrases(120), None, "", "the", words(3, 3000) + " the old man"]
    ids = list(range(len(texts)))
    expected, kept = brute_force(ids, texts, own=40, least=30, depth=3)
    assert {len(c) for c in kept} == {1, 2, 3}
    docs = documents(spark, texts, ids=ids).repartition(3)
    for most in (10**6, 0):
        found = scored(docs, own_count=40, least_context=30, most=most).collect()
        assert len(found) == len(texts)
        for r in found:
            assert math.isclose(r.score, expected[r.doc_id], rel_tol=1e-9), (most, r)


def test_scores_by_parts_of_the_key_space(spark, monkeypatch):
    texts = [*phrases(120), None, "", "the", words(3, 3000) + " the old man"]
    ids = list(range(len(texts)))
    expected, kept = brute_force(ids, texts, own=40, least=30, depth=3)
    by_parts, called = suffix_lm._by_parts, []
    monkeypatch.setattr(suffix_lm, "_by_parts", lambda *a: called.append(a[5]) or by_parts(*a))
    monkeypatch.setattr(suffix_lm, "PART_KEYS", 50)
    docs = documents(spark, texts, ids=ids).repartition(3)
    for most in (2 * len(kept) + 200, 10**6):
        found = scored(docs, own_count=40, least_context=30, most=most).collect()
        assert len(found) == len(texts)
        for r in found:
            assert math.isclose(r.score, expected[r.doc_id], rel_tol=1e-9), (most, r)
        assert called == [1, 2, 3]  # the first depth reads few symbols


def test_sequences_are_asked_for_by_numbers_and_not_by_keys(spark, monkeypatch):
    """A key has 8 bytes; some contexts are heavy here and some are not."""
    texts = [*phrases(120), None, "", "the"]
    ids = list(range(len(texts)))
    expected, kept = brute_force(ids, texts, own=40, least=30, depth=3)
    by_parts, asked = suffix_lm._by_parts, []
    monkeypatch.setattr(suffix_lm, "_by_parts", lambda *a: asked.append(a[0]) or by_parts(*a))
    monkeypatch.setattr(suffix_lm, "PART_KEYS", 1000)
    found = scored(documents(spark, texts, ids=ids).repartition(3), own_count=40, least_context=30, most=2 * len(kept) + 200).collect()
    assert len(found) == len(texts)
    for r in found:
        assert math.isclose(r.score, expected[r.doc_id], rel_tol=1e-9), r
    rows = asked[-1].collect()
    sequences = sum(len(suffix_lm.unpack(np.frombuffer(r.next, np.uint8))) for r in rows)
    assert sequences > 500 and sum(len(r.ctx) + len(r.nexts) + len(r.next) for r in rows) < 5 * sequences


def test_next_symbols_are_sent_packed_by_parts(spark, monkeypatch):
    """As many rows as blocks and parts, not as texts have different next symbols."""
    monkeypatch.setattr(suffix_lm, "PART_KEYS", 1 << 18)
    over, sent = suffix_lm._over_texts, []

    def spy(*a):
        rows = over(*a)
        sent.append(rows.count())
        return rows

    monkeypatch.setattr(suffix_lm, "_over_texts", spy)
    lists = [[1 + zlib.crc32(w.encode()) % 2**30 for w in t.split()] for t in phrases(100)]
    texts = spark.createDataFrame([(0, suffix_lm.pack(np.array(x))[0].tobytes()) for x in lists], "block long, symbols binary").coalesce(1)
    suffix_lm.learn_tree(texts, 1e6, least_context=20)
    assert sent and max(sent) <= 4


def test_more_text_gives_more_contexts_and_symbols(spark):
    sizes = []
    for n in (60, 240):
        sums = suffix_lm.code_blocks(with_folds(documents(spark, phrases(n))))
        own = suffix_lm.count_words(sums, 10).filter("first and c >= 10").count()
        lists = [[1 + zlib.crc32(w.encode()) % 2**30 for w in t.split()] for t in phrases(n)]
        texts = spark.createDataFrame([(0, suffix_lm.pack(np.array(x))[0].tobytes()) for x in lists], "block long, symbols binary")
        tree = suffix_lm.learn_tree(texts, 1e6, least_context=20)
        sizes.append((own, tree.contexts.count()))
    assert sizes[0][0] < sizes[1][0] and sizes[0][1] < sizes[1][1]


def test_contexts_tell_more_than_counts(spark):
    """Texts of two vocabularies: what stood before tells which one goes on."""
    texts = [" ".join([("red", "green", "blue"), ("uno", "dos", "tres")][i % 2] * 20) + " " + words(i, 10) for i in range(60)]
    found = scored(documents(spark, texts), own_count=20, least_context=20).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert found.s > 0.75 * found.b


def test_codes_of_all_sizes_and_endings():
    codes = np.array([0, 1, 127, 128, 16_383, 16_384, 2**21 - 1, 2**21, 2**28, 2**31 - 1] * 3)
    raw, size = suffix_lm.pack(codes)
    assert suffix_lm.unpack(raw).tolist() == codes.tolist() and size.sum() == len(raw) and size.max() == 5
    assert len(suffix_lm.unpack(raw[:0])) == 0


def test_index_finds_all_and_no_others():
    import pyarrow as pa

    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    index = suffix_lm.Index(pa.table({"key": pa.array(keys), "n": pa.array(np.arange(5000))}))
    at = index.find(keys.view(np.uint64))
    assert (index.columns["n"][at] == np.arange(5000)).all() and (index.find((keys + 1).view(np.uint64)) == -1).mean() > 0.99
    assert (suffix_lm.Index(pa.table({"key": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})).find(keys.view(np.uint64)) == -1).all()


def test_only_held_out_rows_and_no_rows(spark):
    held = next(i for i in range(100) if is_out(i))
    row = scored(documents(spark, ["some words"], ids=[held])).first()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 3) and math.isfinite(row.score)
    assert scored(documents(spark, [])).count() == 0
