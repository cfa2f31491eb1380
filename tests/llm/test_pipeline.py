import pytest

import corpus_pipeline
from placeforge.llm import queries
from placeforge.session import durable
from tests.llm.tables import documents, words
from tests.llm.test_joins import brute_similar, edited


def written(spark, folder, texts, ids=None):
    docs = documents(spark, texts, ids=ids)
    docs.write.parquet(f"{folder}/documents.parquet")
    bench = spark.createDataFrame([(0, words(900, 30)), (1, None)], "item_id long, text string")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_each_decision_takes_effect(spark, tmp_path):
    base = words(5, 200)
    texts = [words(i, 60) for i in range(20)] + [None, "", "12 ... !!"] + ["Twice said, twice " + words(30, 12)] * 2 + ["tWICE SAID, TWICE " + words(30, 12)]
    texts += [base, edited(base, [4]), edited(base, [90]), words(50, 20) + ". " + words(900, 30) + " " + words(51, 20)]
    docs = written(spark, str(tmp_path), texts)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = durable(stage(spark, docs, str(tmp_path)), name)
        kept[name] = docs
        if name != "pack":
            assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
    ids = lambda name: sorted(r.doc_id for r in kept[name].select("doc_id").distinct().collect())
    assert ids("language") == [*range(20), *range(23, 30)]
    assert ids("exact_dedup") == [*range(20), *range(25, 30)]
    near = ids("ngram_join")
    classes = brute_similar([texts[i] for i in ids("exact_dedup")], ids("exact_dedup"))
    assert len(near) == len({c for c, _ in classes.values()}) == 23 and len({26, 27, 28} & set(near)) == 1
    assert ids("decontaminate") == [i for i in near if i != 29] == ids("pack")


def test_repeated_and_null_ids_lose_only_copies(spark, tmp_path):
    texts = [words(1, 30), words(1, 30), words(2, 30), words(3, 30), words(4, 30)]
    docs = written(spark, str(tmp_path), texts, ids=[7, 7, 7, None, None])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 7), (False, 7), (True, 0), (True, 0)]
    assert docs.count() == 5


def test_no_rows(spark, tmp_path):
    written(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query_on_the_smallest_tables(spark, name):
    folder = "/root/testdata/sf0.001"
    table = "pages" if name.startswith("op1_") else "documents"
    rows = queries.QUERIES[name](spark, folder).count()
    n = spark.read.parquet(f"{folder}/{table}.parquet").count()
    assert rows < n if name.startswith("op5_") else rows >= n
