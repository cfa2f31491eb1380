"""Small tables with nulls, repeated rows, very long texts and columns whose names clash with the operators' own."""

import random

CLASHING = {"_row": 7, "_doc": "x", "_text": "y", "digest": "d", "score": 0.5, "lang_pred": "zz", "hash": 1, "n": 2, "group": "g", "host": "h", "u": 1, "_place": 3}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH_SCHEMA = "`_row` int, `_doc` string, `_text` string, digest string, score double, lang_pred string, hash int, n int, `group` string, host string, u int, `_place` int"


def words(seed: int, n: int, prefix: str = "") -> str:
    r = random.Random(seed)
    return " ".join(prefix + "".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))


def documents(spark, texts, langs=None, ids=None):
    """A table like ``documents`` with extra columns; ``ids`` default to 0, 1, 2, ..."""
    rows = []
    for i, t in enumerate(texts):
        lang = langs[i] if langs else "en"
        rows.append((ids[i] if ids else i, t, lang, "s", len(t or ""), *CLASHING.values()))
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASH_SCHEMA}")


def odd_texts() -> list:
    long = words(1, 30_000)
    return [
        None, "", " \n\t ", "one", "One", "a b c d e", words(2, 60), words(2, 60).upper(), words(2, 60), long, long, long + " more",
        "Été à la plage. ÉTÉ", "日本語 テキスト", "... --- !!!", "x" * 50_000, "\x01 \x02 sign", "O’Neill's “quoted” 3.5 km.",
    ]
