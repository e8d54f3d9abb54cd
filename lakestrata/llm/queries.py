"""The queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from lakestrata.llm import (
    centroids,
    chat,
    fingerprints,
    near_dedup,
    negatives,
    packing,
    quality_classifier,
    quality_rules,
    repeats,
    sampled_pieces,
    sql,
    token_counts,
    top_k,
    url_filters,
)
from lakestrata.llm.url_filters import Rule
from lakestrata.plans.queries import Registered, table

URL_RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "stratum")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
    return packed.drop("ids")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"])), " ")
    chars = F.aggregate("mask", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"])
    return rotated.select("conv_id", "part", "speaker", "n_turns", "rendered", spans.alias("loss_spans"), chars.alias("loss_chars"))


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_pieces.sampled_encoding(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, sf_dir, "documents"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)


QUERIES: Registered = {
    "op1_url_filters": (op1_url_filters, sql.url_filters_sql(URL_RULES)),
    "op2_quality_rules": (op2_quality_rules, sql.quality_rules_sql()),
    "op3_quality_classifier": (op3_quality_classifier, None),
    "op4_document_fingerprints": (op4_document_fingerprints, None),
    "op5_minhash_near_dedup": (op5_minhash_near_dedup, None),
    "op6_token_counts": (op6_token_counts, None),
    "op7_best_fit_packing": (op7_best_fit_packing, None),
    "op8_chat_formatting": (op8_chat_formatting, sql.chat_sql()),
    "op9_sampled_pieces": (op9_sampled_pieces, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op10_suffix_array_dedup": (op10_suffix_array_dedup, None),
    "op11_exact_top_k": (op11_exact_top_k, sql.top_k_sql()),
    "op12_centroid_clustering": (op12_centroid_clustering, sql.clustering_sql()),
    "op13_hard_negatives": (op13_hard_negatives, sql.negatives_sql()),
}
