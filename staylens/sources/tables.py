"""Stored inputs: Parquet tables with known schemas, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens import schemas


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def pages(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.PAGES)


def search_views(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.SEARCH_VIEWS)


def page_elements(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.PAGE_ELEMENTS)


def review_pages(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.REVIEW_PAGES)


def review_cards(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.REVIEW_CARDS)


def geocodes(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.GEOCODES)


def stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None, glob: str | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream; ``files_per_batch`` is the flush size."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Make frames available to ``spark.sql`` under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
