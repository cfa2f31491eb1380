"""The registered queries: each applies its operator to the whole of its table with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.llm import (
    decontaminate, exact_dedup, html_wrapper, language, merkle, ngram_join, oracle, packing, quality, quality_rules, ranked_search, suffix_lm,
    token_counts, token_files,
)
from placeforge.llm.words import id_remainder, texts_of
from placeforge.session import durable, work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(_table(spark, sf_dir, "pages"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", id_remainder(4) == 2)
    model = language.fit(docs.filter("not held_out"))
    return language.predict(docs, model, keys=("doc_id", "held_out"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = durable(quality.statistics_of(_table(spark, sf_dir, "documents")), "statistics")
    labels = _table(spark, sf_dir, "labels").filter(id_remainder(5) != 0).select("doc_id", "quality")
    model = quality.fit(stats.join(labels, "doc_id"))
    scored = quality.score_documents(stats, model)
    return scored.select("doc_id", (id_remainder(5) == 0).alias("held_out"), "score", "predicted")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path)
    return token_files.digest(token_files.read_token_files(spark, path))


def op10_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score_documents(texts_of(_table(spark, sf_dir, "documents")).withColumn("held_out", id_remainder(7) == 2))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("rejected_by")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_html_wrapper": op1_html_wrapper,
    "op2_ngram_join": op2_ngram_join,
    "op3_pack": op3_pack,
    "op4_token_counts": op4_token_counts,
    "op5_decontaminate": op5_decontaminate,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_token_files": op9_token_files,
    "op10_suffix_lm": op10_suffix_lm,
    "op11_ranked_search": op11_ranked_search,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL = oracle.ORACLE_SQL
