"""The registered queries of the operators on text and vectors, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm import (
    bpe,
    decontaminate,
    fingerprints,
    language_id,
    line_dedup,
    lm,
    merkle,
    near_dedup,
    quality_rules,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from pagetrail.llm.text import fold, table
from pagetrail.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.contaminated_documents(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    network = language_id.train(docs, learns=~held_out)
    return language_id.identify(docs, network).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives, index = scratch_path(spark, "archives"), scratch_path(spark, "captures")
    pages = table(spark, sf_dir, "pages")
    warc.write_archives(pages, archives)
    warc.write_index(warc.captures(spark, archives), index)
    return warc.read_back(pages, index)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    classifier = toxicity.train(docs, table(spark, sf_dir, "labels"), learns=~held_out)
    return toxicity.score(docs, classifier).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    scored = lm.score(docs, learns=~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.edited_neighbours(docs)


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_near_dedup": op2_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_url_filter": op5_url_filter,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_line_dedup": op8_line_dedup,
    "op9_bpe": op9_bpe,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_fingerprints": op13_fingerprints,
}
