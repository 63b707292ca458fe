"""An error channel: one pass gives readable rows and, for the others, a reason and what was read.

No row is lost and none ends a run: every input row is one row of the channel, either with its
fields and the reason NULL, or with a reason and the raw texts that could not be read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.text import blank_to_null, strip
from staylens.functions.workspace import stored

REASON, INPUT = "reason", "input"


class Reading(NamedTuple):
    """A field read from a raw text by an expression that gives NULL where it cannot."""

    raw: Column
    value: Column
    required: bool = False


def channel(df: DataFrame, keep: Sequence[str], readings: Mapping[str, Reading]) -> DataFrame:
    """``keep``, the fields, ``reason`` and ``input``, one row per row of ``df``.

    A field whose raw text is not blank but whose value is NULL is unreadable; a required
    field without a text is missing.  ``input`` joins the raw texts of unreadable fields.
    The values are computed once; a row with a reason keeps the fields that could be read.
    """
    raws = {name: f"raw_{i}" for i, name in enumerate(readings)}
    read = df.select(
        *keep,
        *(r.raw.cast("string").alias(raws[name]) for name, r in readings.items()),
        *(r.value.alias(name) for name, r in readings.items()),
    )

    def given(name: str) -> Column:
        return blank_to_null(strip(F.col(raws[name]))).isNotNull()

    def problem(name: str, required: bool) -> Column:
        unreadable = F.when(given(name) & F.col(name).isNull(), F.lit(f"unreadable {name}"))
        missing = F.when(~given(name) & F.col(name).isNull(), F.lit(f"missing {name}"))
        return F.coalesce(unreadable, missing) if required else unreadable

    problems = F.array_compact(F.array(*(problem(n, r.required) for n, r in readings.items())))
    spoilt = F.array_compact(F.array(*(F.when(given(n) & F.col(n).isNull(), F.col(raws[n])) for n in readings)))
    return read.select(
        *keep,
        *readings,
        F.when(F.size(problems) > 0, F.array_join(problems, ", ")).alias(REASON),
        F.when(F.size(spoilt) > 0, F.array_join(spoilt, " | ")).alias(INPUT),
    )


def good(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON, INPUT)


def bad(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())


def channel_counts(rows: DataFrame) -> DataFrame:
    """Rows read, readable and not: one row, also for an empty input."""
    failed = F.count(F.when(F.col(REASON).isNotNull(), 1))
    return rows.agg(F.count("*").alias("n_input"), (F.count("*") - failed).alias("n_good"), failed.alias("n_bad"))


def page_channel(pages: DataFrame, elements: Column, html: str = "html") -> DataFrame:
    """Stored pages with ``reason``: no page, a blank one, or one that the element step could not read.

    ``elements`` is the result of that step on the page, NULL if it failed.
    """
    kept = [c for c in pages.columns if c != html]
    bare = blank_to_null(strip(F.col(html)))
    reason = (
        F.when(F.col(html).isNull(), "missing page")
        .when(bare.isNull(), "blank page")
        .when(F.col("elements").isNull(), "unreadable page")
    )
    read = pages.withColumn("elements", elements)
    return read.select(*kept, "elements", reason.alias(REASON), F.when(reason.isNotNull(), F.substring(html, 1, 200)).alias(INPUT))


def _lines(spark: SparkSession, kind: str, path: str, schema: T.StructType, options: Mapping[str, object]) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(INPUT, T.StringType())])
    reader = spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", INPUT)
    read = reader.options(**options).format(kind).load(path)
    reason = F.when(F.col(INPUT).isNotNull(), F.lit("unreadable line")).alias(REASON)
    # parsed once and stored: good rows, bad rows and counts are read from there
    return stored(read.select(*schema.names, reason, INPUT, F.col("_metadata.file_path").alias("file")), "lines")


def csv_channel(spark: SparkSession, path: str, schema: T.StructType, **options: object) -> DataFrame:
    """Lines of CSV files by a schema; a line that does not fit it has a reason and the line itself."""
    return _lines(spark, "csv", path, schema, {"columnPruning": False, **options})


def json_channel(spark: SparkSession, path: str, schema: T.StructType, **options: object) -> DataFrame:
    """Lines of JSON files by a schema, such as stored geocoder responses."""
    return _lines(spark, "json", path, schema, options)
