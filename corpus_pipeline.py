"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm import near_dedup, packing, quality_classifier, quality_rules, repeats
from lakestrata.session import new_scratch


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, _labels(spark, sf_dir))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the risk-controlled cutoffs of their language."""
    return quality_rules.keep_documents(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies."""
    return near_dedup.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later occurrences of repeated passages."""
    return repeats.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids, one row per piece with its ids' checksum."""
    packed = packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    return packed.drop("ids")


STAGES = (
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
)

#: Neither training nor hashing, suffix sorting and tokenizing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_scratch(spark, name)
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
