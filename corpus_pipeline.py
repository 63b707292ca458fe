"""Corpus pipeline: language, quality, near copies, benchmark passages, packing."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from staylens.functions.workspace import stored
from staylens.llm import decontamination, language, near_dedup, packing, quality

VOCABULARY = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that can be told; texts without a letter and uncertain ones go."""
    return language.accepted(docs, language.train(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the least id, of each class of near copies."""
    return near_dedup.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents of which a twentieth or more stands in benchmark passages."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lay what is left into training sequences."""
    return packing.pack(docs, tokenizer_path(VOCABULARY))


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("near-dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# classifiers and sampling have no form in SQL: tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
