"""Writing records: Parquet with NULL kept, CSV with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.rules import HEAD_CHARACTERS
from staylens.operators.record import export_defaults
from staylens.sources.exports import CSV_OPTIONS, header


def write_records(record: DataFrame, path: str, run_id: str) -> None:
    """One Parquet partition per run; repeating a run replaces its own rows only."""
    (
        record.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All runs; a column that only some runs have is NULL in the others."""
    return spark.read.option("mergeSchema", True).parquet(path)


def append_csv(record: DataFrame, path: str) -> None:
    """Append to a CSV folder, header once per file.

    Every file of the folder has to carry the same header, so a batch with
    columns the folder does not know is refused instead of written wider than
    its header; a batch that lacks some gets them as missing values.
    """
    spark = record.sparkSession
    exported = export_defaults(record)
    known = existing_header(spark, path)
    if known:
        new = [c for c in exported.columns if c not in known]
        if new:
            raise ValueError(f"columns not in the header of {path}: {new}; export to a new folder")
        exported = exported.select(*[F.col(c) if c in exported.columns else F.lit("0").alias(c) for c in known])
    exported.write.mode("append").options(**CSV_OPTIONS).csv(path)


def existing_header(spark: SparkSession, path: str) -> list[str]:
    from pyspark.errors import AnalysisException

    try:
        return header(spark, path)
    except AnalysisException:
        return []


def export_csv(record: DataFrame, path: str) -> None:
    export_defaults(record).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def export_run(record: DataFrame, path: str, run: str) -> None:
    """One CSV folder per run, each with the columns that its records have; a run that is repeated replaces itself.

    ``sources.exports.read_runs`` lays runs with different columns together by name.
    """
    export_defaults(record).write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{path}/run={run}")


def page_heads(pages: DataFrame, characters: int = HEAD_CHARACTERS) -> DataFrame:
    """Start of each raw page, for looking at what was captured."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, F.substring("html", 1, characters).alias("head"))


def write_page_heads(pages: DataFrame, path: str) -> None:
    page_heads(pages).write.mode("overwrite").parquet(path)
