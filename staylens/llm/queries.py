"""Registered queries of the corpus operators."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import (
    alignment,
    decontamination,
    extraction,
    fingerprints,
    hard_negatives,
    language,
    near_dedup,
    packing,
    parity_join,
    quality,
    sharding,
    toxicity,
    warc,
)
from staylens.llm.oracles import ORACLES

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(VOCABULARY))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontamination.build_index(_table(spark, sf_dir, "documents"))
    return decontamination.contamination(index, _table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sharding.sized(_table(spark, sf_dir, "documents"))
    return sharding.interleave(sized, ties=("text_crc32", "size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, folder, mode="FAILFAST").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"), tokenizer_path(VOCABULARY), tokenizer_path(PIECES))


def op12_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = parity_join.jaccard_links(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_near_dedup": op4_near_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_extraction": op8_extraction,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_parity_join": op12_parity_join,
    "op13_hard_negatives": op13_hard_negatives,
}
