"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    apportioned_mix,
    cgk_leaks,
    disclosure_pii,
    feistel_shards,
    hidden_markov,
    hypervectors,
    importance_resampling,
    line_dedup,
    minmax_dedup,
    quality_rules,
    simplex_clusters,
    subword_quality,
    url_model,
)
from tidemark.llm.common import staged, table, words


def op1_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_model.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minmax_dedup.near_duplicates(docs, width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules.judge(docs).select("doc_id", *counts, "base_failed", "kept")


def op4_cgk_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cgk_leaks.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op5_hypervector_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hypervectors.held_out_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def op6_apportioned_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    version = F.xxhash64("text").alias("version")  # tells rows with one id apart
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), version)
    mixed = apportioned_mix.mix(staged(sized, "sized"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = feistel_shards.shard(docs, shards=40, keys=["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return subword_quality.held_out_quality(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return line_dedup.drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op10_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    counts = [f"n_{kind}" for kind in disclosure_pii.KINDS]
    return disclosure_pii.sanitise(docs).select("doc_id", *counts, digest, "spans")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance_resampling.resample(docs, table(spark, sf_dir, "benchmark").select("text"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = hypervectors.held_out("doc_id", 5, 1)
    found = hidden_markov.score_texts(docs, ~held_out)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return simplex_clusters.cluster(vectors).drop("centroid")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_model": op1_url_model,
    "op2_minmax_dedup": op2_minmax_dedup,
    "op3_quality_cascade": op3_quality_cascade,
    "op4_cgk_leaks": op4_cgk_leaks,
    "op5_hypervector_language": op5_hypervector_language,
    "op6_apportioned_mix": op6_apportioned_mix,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_subword_quality": op8_subword_quality,
    "op9_line_dedup": op9_line_dedup,
    "op10_disclosure_pii": op10_disclosure_pii,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_simplex_clusters": op13_simplex_clusters,
}
