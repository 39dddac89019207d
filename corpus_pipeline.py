"""Corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing to target weights, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which the
runner writes as Parquet and reads back as the next stage's documents.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from lakemart.sources.paths import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.keep_passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, the one with the largest id."""
    return exact_dedup.keep_one_copy(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of texts alike in 0.8 of their five-word shingles, the one with the smallest id."""
    return ngram_join.keep_one_of_each(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: one row per document, pass and unbroken run of taken words."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two lengths, with their ids."""
    return packing.training_sequences(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near-duplicate join", near), ("mixing", mix), ("packing", pack)]

#: The mix draws from Spark's hashes and the packing uses a tokenizer, so SQL cannot say what the run returns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
