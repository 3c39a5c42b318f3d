"""The corpus pipeline: five stages from raw documents to packed sequences, each on all that the one before it kept.

A stage is written as Parquet in the shared folder and read again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe_codec, ngram_join, packing, pii, quality_classifier, quality_rules
from tallyloom.llm.queries import VOCABULARY, packed_digest, read
from tallyloom.session import apply_settings, scratch_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the likelihood ratio go."""
    return quality_rules.keep_good(docs, read(apply_settings(spark), sf_dir, "labels"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the importance sample go."""
    return quality_classifier.keep_selected(docs, read(apply_settings(spark), sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    apply_settings(spark)
    return ngram_join.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, become labels."""
    apply_settings(spark)
    return pii.sanitise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts become pieces of sequences."""
    return packed_digest(packing.pack(docs, bpe_codec.vocabulary(apply_settings(spark), VOCABULARY)))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_duplicates", near_duplicates_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
#: SQL has neither the hashes of the models nor the tokenizer; tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
