import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from placeforge.llm import merkle, quality_rules, ranked_search
from tests.llm.tables import SCHEMA, documents, odd_texts, words

# ---- ranked search


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def brute_search(docs, items, best):
    """[(item_id, rank, doc_id, score)] of (doc_id, text) and (item_id, text)."""
    counts = [(i, r, Counter(terms_of(t))) for r, (i, t) in enumerate(docs)]
    counts = [c for c in counts if c[2]]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, _, c in counts)
    df = Counter(t for _, _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        found = []
        for doc_id, row, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, row, doc_id))
        out += [(item, rank + 1, f[4], -f[0]) for rank, f in enumerate(sorted(found)[:best])]
    return sorted(out, key=repr)


def searched(spark, docs, items, best=5, extra=False):
    table = documents(spark, [t for _, t in docs], ids=[i for i, _ in docs]) if docs else documents(spark, ["x"]).limit(0)
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("clash")).withColumn("row", F.lit(1))
    index = ranked_search.build_index(table)
    return sorted((tuple(r) for r in ranked_search.search(index, queries, best).collect()), key=repr)


@pytest.mark.parametrize(("piece", "block"), [(1_000_000, 100_000), (300, 25)])
def test_search_against_all_scores(spark, monkeypatch, piece, block):
    monkeypatch.setattr(ranked_search, "PIECE_POSTINGS", piece)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    r = random.Random(5)
    common = words(3, 12).split()
    texts = [" ".join(r.choice(common) for _ in range(r.choice([3, 8, 20, 90]))) + " " + words(100 + i, r.choice([0, 5, 40])) for i in range(120)]
    texts += [texts[0]] * 30 + odd_texts()  # one text a fifth of all, ties by id
    docs = [(None if i == 7 else (i * 37) % 101, t) for i, t in enumerate(texts)]  # repeated ids and a null one
    items = [(i, " ".join(r.choice(common) for _ in range(6)) + " " + texts[i]) for i in range(9)]
    items += [(20, common[0]), (20, common[1].upper()), (None, texts[3]), (21, None), (22, ""), (23, "nowhereatall"), (24, "ÉTÉ été"), (25, "--- one !!")]
    assert searched(spark, docs, items) == brute_search(docs, items, 5)


def test_search_of_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, None), (2, " -- ")], [(1, "a")]) == []
    index = ranked_search.build_index(documents(spark, ["a b"]))
    assert ranked_search.search(index, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_strata_out_of_reach_are_not_scored():
    import pyarrow as pa

    strata = {50: [3, 3], 90: [1] * 4}  # m: tf of each document; the first stratum's scores are beyond the second's bound
    batch = pa.RecordBatch.from_pydict(
        {"piece": [0, 0], "term": [None, "a"], "df": [6, 6], "m": [[50, 90], [50, 90]], "tf": [[], [3, 1]], "runs": [[2, 4], [2, 4]],
         "docs": [[], list(range(6))], "ids": [list(range(6)), None], "rows": [list(range(6)), None]},
        schema=pa.schema([("piece", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("m", pa.list_(pa.int64())), ("tf", pa.list_(pa.int32())),
                          ("runs", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64()))]),
    )
    assert sum(map(len, strata.values())) == 6
    best = ranked_search._Best(1, 2)
    added = []
    keep = best.add
    best.add = lambda q, *rows: (added.append(len(rows[0])), keep(q, *rows))[1]
    ranked_search._search_piece(pa.Table.from_batches([batch]), ranked_search._Queries([{"item": 0, "terms": ["a"], "weights": [100]}]), best)
    assert added == [2] and best.rows[0][2].tolist() == [0, 1]


# ---- quality rules


def brute_statistics(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(ws)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed, len(lines)


def test_rule_statistics(spark):
    texts = odd_texts() + ["a b c a b c", "a a a a", "x y z\n\nx y z\n \nx y z", "p q\vr\fs", "1|2 <b> #x 50%", "é ü\n" * 3, words(9, 25_000) + " " + words(9, 40)]
    found = {r["doc_id"]: r for r in quality_rules.filter_documents(documents(spark, texts), labels(spark, [])).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, dups, repeated, failed, _ = brute_statistics(t)
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (n, chars, symbols, dups, repeated, failed), t
        assert r["kept"] == (not failed)  # no labels, no rules


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int").withColumn("stratum", F.lit("clash")).withColumn("toxic", F.lit(0))


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.01), (3, 40, 0.2), (0, 1000, 0.01), (7, 900, 0.01), (5, 5, 0.5), (1900, 200_000, 0.01)]
    for k, n, rate in cases:
        row = spark.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), rate)).first()[0]
        if k >= n * rate:
            assert row == 1.0
        elif n < 5000:
            p = Fraction(rate)
            exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert row == pytest.approx(float(exact), rel=1e-9)
        else:
            assert 0.005 < row < 0.02  # 2.25 deviations below the mean


def brute_cutoffs(docs, marks, rate, risk):
    """{(stratum, rule): cutoff} of (id, text, lang) and [(id, quality)] by the definition."""
    texts = {}
    for i, t, lang in docs:
        s = brute_statistics(t)
        for j, q in marks:
            if j == i and q is not None and not s[5]:
                texts.setdefault((lang, t or ""), [s, False])
                texts[lang, t or ""][1] |= q == 1
    value = {
        "symbols": lambda s: s[2] / s[0], "copied_lines": lambda s: s[3] / max(s[6], 1), "repeated_words": lambda s: s[4] / s[0],
        "long_words": lambda s: s[1] / s[0], "short_words": lambda s: s[1] / s[0],
    }
    langs = {lang for (lang, _), (_, good) in texts.items() if good}
    tests, out = len(langs) * len(quality_rules.RULES), {}
    part = rate / len(quality_rules.RULES)
    for lang in langs:
        own = [(s, good) for (x, _), (s, good) in texts.items() if x == lang]
        n = sum(good for _, good in own)
        for rule, _, above, cutoffs in quality_rules.RULES:
            best = (0, None)
            for c in cutoffs:
                out_of = lambda s: value[rule](s) > c if above else value[rule](s) < c  # noqa: E731, B023
                k, b = sum(good and out_of(s) for s, good in own), sum(not good and out_of(s) for s, good in own)
                p = sum(math.comb(n, i) * part**i * (1 - part) ** (n - i) for i in range(k + 1)) if k < n * part else 1.0
                if p > risk / tests:
                    break  # the ladder's first failure ends it
                if b > best[0]:
                    best = (b, c)
            if best[1] is not None:
                out[lang, rule] = best[1]
    return out


def test_rules_against_the_definition(spark):
    r = random.Random(11)
    docs, marks = [], []
    for i in range(700):
        lang = r.choice(["en", "en", "de", None])
        good = r.random() < 0.7
        n = r.randint(50, 70)
        text = words(1000 + i, n)
        if r.random() < (0.02 if good else 0.8):  # symbols at various rates
            rate = r.choice([0.1, 0.25, 0.6, 1.2])
            text = " ".join(w + "|" * (r.random() < rate) for w in text.split())
        if not good and r.random() < 0.4:
            text = "\n".join([words(5000 + i, 12)] * r.randint(1, 2) + [text])
        docs.append((i, text, lang))
        marks.append((i, int(good)))
    docs += [(2000 + i, docs[0][1], docs[0][2]) for i in range(200)]  # copies count once
    marks += [(2000 + i, 1) for i in range(200)] + [(3, None), (4, 1), (9999, 1), (None, 0)]
    docs += [(3000, None, "en"), (3001, "", None), (3002, words(1, 80), "xx")]
    table = documents(spark, [t for _, t, _ in docs], [x for _, _, x in docs], [i for i, _, _ in docs])
    stats = quality_rules.statistics_of(table)
    cutoffs = quality_rules.certify(stats, labels(spark, marks), 0.3, 0.2)
    want = brute_cutoffs(docs, marks, 0.3, 0.2)
    name = lambda s: None if s == "-" else s[1:]
    assert want and {(name(c["stratum"]), c["rule"]): c["cutoff"] for c in cutoffs.collect()} == want
    kept = {(x["doc_id"]): x for x in quality_rules.verdicts(stats, cutoffs).collect()}
    assert len(kept) == len(docs)
    for i, t, lang in docs:
        s = brute_statistics(t)
        value = {"symbols": s[2], "long_words": s[1], "short_words": s[1], "repeated_words": s[4], "copied_lines": s[3]}
        out = {
            rule for rule, _, above, _ in quality_rules.RULES
            if (c := want.get((lang, rule))) is not None and s[0]
            and ((v := value[rule] / (max(s[6], 1) if rule == "copied_lines" else s[0])) > c if above else v < c)
        }
        assert kept[i]["kept"] == (not s[5] and not out) and set(kept[i]["rejected_by"]) == out, (i, t)


def test_rules_lose_few_good_texts(spark):
    """With statistics that say nothing of quality, no rule may take more than its part."""
    r = random.Random(3)
    docs = [" ".join(w + "#" * (r.random() < 0.3) for w in words(i, 60).split()) for i in range(600)]
    stats = quality_rules.statistics_of(documents(spark, docs))
    cutoffs = quality_rules.certify(stats, labels(spark, [(i, int(r.random() < 0.5)) for i in range(600)]), 0.1, 0.05).collect()
    assert all(c["good_rejected"] <= 0.02 * c["good"] for c in cutoffs)


def test_rules_on_empty_tables(spark):
    empty = documents(spark, ["x"]).limit(0)
    assert quality_rules.filter_documents(empty, labels(spark, [(1, 1)])).count() == 0


# ---- manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] of rows (doc_id, text, lang, source, n_chars)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, source, n: sha(*map(field, (i, source, lang, n, t)))

    def climb(nodes):
        paths = [[] for _ in nodes]
        spans = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            parents, wider = [], []
            for a in range(0, len(nodes), 8):
                run = nodes[a : a + 8]
                for k in range(len(run)):
                    for i in spans[a + k]:
                        paths[i].append((run[:k], run[k + 1 :]))
                parents.append(sha(*run))
                wider.append(sum(spans[a : a + 8], []))
            nodes, spans = parents, wider
        return (nodes or [None])[0], paths

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(groups[lang], key=lambda x: (x[0] is not None, x[0] or 0, leaf(*x)))
        trees[lang] = (own, *climb([leaf(*x) for x in own]))
    root, upper = climb([trees[lang][1] for lang in langs])
    out = []
    for lang, up in zip(langs, upper, strict=True):
        own, subroot, paths = trees[lang]
        for row, path in zip(own, paths, strict=True):
            path = path + up
            i, t = row[0], row[1]
            start = leaf(i, lower(t) if t is not None else None, *row[2:]) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else leaf(*row)
            h = start
            for left, right in path:
                h = sha(*left, h, *right)
            out.append((i, leaf(*row), subroot, root, sha(*[x for left, right in path for x in left + right]), h, h == root))
    return sorted(out, key=repr)


def manifest_rows(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("_row", F.lit(1)).withColumn("g", F.lit("clash")).withColumn("pos", F.lit(0)).withColumn("h", F.lit(0))
    return sorted((tuple(r) for r in merkle.verify(merkle.manifest(table)).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 4])
def test_manifest_against_trees_built_by_hand(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "CHUNK", 8**levels)
    r = random.Random(2)
    rows = [(None if i == 3 else (i * 7) % 61, t, r.choice(["en", None, "zz", "é", "Z"]), "s", len(t or "")) for i, t in enumerate(odd_texts() * 2)]
    rows += [(100 + i, f"Text {i}", "hot", None if i % 5 else "S", None if i % 7 == 0 else i) for i in range(131)]
    rows += [(5000, "Lone", "one", None, None), (5001, "", "", "", 0)] + [(6000, "same", "hot", "s", 4)] * 9
    found = manifest_rows(spark, rows)
    assert found == brute_manifest(rows)
    assert 0 < sum(not f[-1] for f in found) < len(found)


@pytest.mark.parametrize("count", [0, 1, 2, 8, 9])
def test_manifest_of_few_rows(spark, count):
    rows = [(i, f"T{i}", f"l{i}" if count == 9 else "en", "s", 2) for i in range(count)]
    assert manifest_rows(spark, rows) == brute_manifest(rows)
