"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``. Rows are told apart by a number of their own, so repeated
or null ids and columns with any names do no harm; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import decontaminate, exact_dedup, language, ngram_join, packing
from placeforge.llm.rows import by_row, new_folder, numbered, remove, without

LEAST_LANGUAGE_SCORE = 0.25  # texts of two or three languages stay


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of which no language has a sure quarter."""
    model = language.fit(docs)
    whole = docs.select(F.struct("*").alias("_doc"), F.col("text"))
    found = language.predict(whole, model, keys=("_doc",))
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(sure).select("_doc.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest doc_id stays."""
    rows = numbered(docs)
    texts = rows.select("_row", F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.text").alias("text"))
    groups = exact_dedup.duplicate_groups(texts, row="_row")
    return without(rows, groups.filter("not kept"), "_row")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of at least 0.8, directly or through others, the first row stays."""
    rows = numbered(docs)
    classes = ngram_join.similar_documents(by_row(rows))
    return without(rows, classes.filter("doc_id != class_id"), "doc_id")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, as it is or with other numbers, names or units."""
    rows = numbered(docs)
    held = decontaminate.contaminated(by_row(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(rows, held, "doc_id")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places in sequences of 2,048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("decontaminate", without_benchmarks),
    ("pack", packed),
]

ORACLE_SQL = None  # language models, tokens and packing are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
