"""The corpus operators over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestlift.llm import quality, toxicity
from nestlift.llm.common import fold, read
from nestlift.llm.divergence import divergence
from nestlift.llm.fingerprint import edited_fingerprints
from nestlift.llm.line_dedup import mark_runs, without
from nestlift.llm.mixing import mix
from nestlift.llm.near_dedup import near_classes
from nestlift.llm.packing import pack
from nestlift.llm.quality_rules import judge
from nestlift.llm.site_tree import extract
from nestlift.llm.token_count import count_tokens
from nestlift.llm.url_filter import judge_urls
from nestlift.llm.va_file import cluster

# (rule, allow): a host with its subdomains and a path prefix
URL_RULES = [("com/", True), ("example.com/en/", False), ("www.example.com/en/", True), ("net/es/", False),
             ("net/fr/", False)]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return (quality.score_quality(docs, model)
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read(spark, sf_dir, "documents")).drop("_k1", "_k2")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return (toxicity.score_toxicity(docs, model)
            .select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("copies", "source", "shard", "quota")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_runs(read(spark, sf_dir, "documents"))
    cut = F.col("_cut")
    return marked.select(
        "doc_id", F.when(cut.isNull(), F.col("text")).otherwise(without(F.col("text"), cut)).alias("text"),
        F.coalesce(F.aggregate(cut, F.lit(0), lambda n, x: n + x["p1"] - x["p0"] + 1), F.lit(0)).alias("deleted_lines"),
        F.to_json(F.transform(cut, lambda x: F.array(x["p0"], x["p1"]))).alias("deleted_runs"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(read(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_source_mixing": op9_source_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_html_extraction": op12_html_extraction,
    "op13_centroid_clustering": op13_centroid_clustering,
}
