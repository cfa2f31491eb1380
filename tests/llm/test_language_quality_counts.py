import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placeforge.llm import language, quality, token_counts
from tests.llm.tables import documents, odd_texts, words


def test_token_counts_against_whole_table_of_segmentations(spark):
    pieces, per_byte = token_counts.load_pieces(token_counts.default_pieces())

    def brute(word):
        text = token_counts.WORD_MARK + word
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            ways = [(best[s][0] + pieces[text[s:end]], -best[s][1] - 1) for s in range(end) if text[s:end] in pieces]
            if text[end - 1] not in pieces:
                n = len(text[end - 1].encode())
                ways.append((best[end - 1][0] + n * per_byte, -best[end - 1][1] - n))
            top = max(ways)
            best.append((top[0], -top[1]))
        return best[-1][1]

    texts = [t if t is None or len(t) < 5000 else t[:3000] for t in odd_texts()]
    found = {r.doc_id: r for r in token_counts.token_counts(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = (t or "").split()
        assert (found[i].n_words, found[i].n_distinct, found[i].n_tokens) == (len(w), len(set(w)), sum(map(brute, w)))
    assert token_counts.token_counts(documents(spark, [])).count() == 0


def two_languages(spark):
    a = [words(i, 40, "qu") for i in range(20)]
    b = [words(i, 40, "zh") for i in range(20, 40)]
    ru = ["привет это русский текст про погоду и дом"] * 4
    return documents(spark, [*a, *b, *ru, None, "x"], ["aa"] * 20 + ["bb"] * 20 + ["ru"] * 4 + ["aa", None])


def test_language_of_texts_and_spans(spark):
    model = language.fit(two_languages(spark))
    assert model.languages == ["aa", "bb", "ru"]
    mixed = words(70, 30, "qu") + " " + words(71, 25, "zh") + " это погода и дом"
    texts = [words(50, 20, "qu"), words(51, 20, "zh"), mixed, None, "", "12 34 ...", "日本", "текст", words(3, 20_000, "zh")]
    found = {r.doc_id: r for r in language.predict(documents(spark, texts), model, with_spans=True).collect()}
    assert [found[i].lang_pred for i in range(6)] == ["aa", "bb", "aa", "und", "und", "und"]
    assert found[7].lang_pred == "ru" and found[8].lang_pred == "bb" and found[6].lang_pred in model.languages
    assert [(s.lang, s.first_word, s.n_words) for s in found[2].spans] == [("aa", 0, 30), ("bb", 30, 25), ("ru", 55, 4)]
    assert all(0 <= r.score <= 1 for r in found.values()) and found[3].score == 0 and found[3].spans == []


@pytest.mark.parametrize("seed", range(4))
def test_best_path_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    counts = np.array([0, 1, 7, 3, 6])
    scores = rng.normal(0, 2, (counts.sum(), 3))
    path, _ = language.label_words(scores, counts, penalty=1.5)
    at = 0
    for n in counts.tolist():
        value = lambda p: sum(scores[at + i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in itertools.pairwise(p))  # noqa: B023, E731
        best = max((value(p) for p in itertools.product(range(3), repeat=n)), default=0.0)
        assert math.isclose(value(path[at : at + n].tolist()), best, abs_tol=1e-9)
        at += n


@pytest.mark.parametrize("seed", range(40))
def test_best_path_without_the_best_single_language(seed):
    """Gains between half a penalty and a penalty: the best path may never use the language that is best for the whole."""
    path, _ = language.label_words(np.array([[0.0, -5.0, -20.0], [-20.0, -5.0, 0.0]]), np.array([2]), penalty=8.0)
    assert path.tolist() == [0, 2]
    rng = np.random.default_rng(seed)
    counts = np.array([2, 4, 6])
    scores = rng.uniform(-20, 0, (counts.sum(), 3))
    scores[:, 1] = rng.uniform(-6, -3, counts.sum())
    path, _ = language.label_words(scores, counts, penalty=8.0)
    at = 0
    for n in counts.tolist():
        value = lambda p: sum(scores[at + i, k] for i, k in enumerate(p)) - 8.0 * sum(a != b for a, b in itertools.pairwise(p))  # noqa: B023, E731
        best = max(value(p) for p in itertools.product(range(3), repeat=n))
        assert math.isclose(value(path[at : at + n].tolist()), best, abs_tol=1e-9)
        at += n


def test_language_without_labels_and_rows(spark):
    none = language.fit(documents(spark, []))
    assert [r.lang_pred for r in language.predict(documents(spark, ["some words", None]), none).collect()] == ["und", "und"]
    assert language.predict(documents(spark, []), none).count() == 0


def junk(i):
    return [words(i, 30).upper().replace(" ", "!! "), "$$$ ".join(words(i, 40).split()), " ".join([words(i, 1)] * 60)][i % 3]


def test_quality_separates_and_agrees_with_plain_formula(spark):
    texts = [words(i, 20 + i) + "." for i in range(60)] + [junk(i) for i in range(30)] + [None, ""]
    stats = quality.statistics_of(documents(spark, texts)).cache()
    labels = [(i, int(i < 60)) for i in range(90) if i % 3] + [(4, None), (None, 1), (5, 1), (999, 0)]
    labelled = stats.join(spark.createDataFrame(labels, "doc_id long, quality int"), "doc_id")
    model = quality.fit(labelled)
    found = {r.doc_id: r for r in quality.score_documents(stats, model).collect()}
    assert len(found) == 92 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [i for i in range(90) if not i % 3]
    assert np.mean([found[i].predicted == (i < 60) for i in held]) > 0.9
    rows = labelled.filter("quality is not null").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.quality for r in rows])
    assert np.allclose(model.mean[1], x[y == 1].mean(axis=0))
    common = sum(np.cov(x[y == c].T, bias=True) * (y == c).sum() for c in (0, 1)) / len(y)
    own = 0.95 * np.cov(x[y == 0].T, bias=True) + 0.05 * common
    own = 0.95 * own + 0.05 * np.diag(np.diag(own)) + quality.LEAST_VARIANCE * np.eye(len(own))
    assert np.allclose(np.linalg.inv(model.whiten[0].T @ model.whiten[0]), np.linalg.inv(np.linalg.inv(own)), atol=1e-6)
    stats.unpersist()


def test_quality_with_one_class_or_none(spark):
    stats = quality.statistics_of(documents(spark, odd_texts()))
    label = lambda v: stats.select("x", F.lit(v).cast("int").alias("quality"))
    assert {r.score for r in quality.score_documents(stats, quality.fit(label(1))).collect()} == {1.0}
    assert {r.score for r in quality.score_documents(stats, quality.fit(label(None))).collect()} == {0.5}
    assert quality.statistics_of(documents(spark, [])).count() == 0


def test_statistics_of_known_text():
    x = quality.statistics(pa.array(["AB cd. AB\nAB cd. AB\n12", ""]))
    s = dict(zip(quality.STATISTICS, x[0], strict=True))
    assert math.isclose(s["log_words"], math.log(8)) and math.isclose(s["log_lines"], math.log(4))
    assert math.isclose(s["upper"], math.log(8 / 16 + 0.01)) and math.isclose(s["digit"], math.log(2 / 16 + 0.01))
    assert np.isfinite(x).all()
