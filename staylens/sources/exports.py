"""Reading exported CSV back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators.record import restore_nulls
from staylens.schemas import count_column, mean_column

# Doubled quotes inside quoted fields, blanks as blanks, no trimming.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "\u0000",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of an exported file or folder."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def _extra_type(name: str) -> T.DataType:
    """Type of a column outside the fixed list, by the naming rule of the pairs."""
    prefix, suffix = mean_column(""), count_column("")[len(mean_column("")) :]
    if name.startswith(prefix):
        return T.LongType() if name.endswith(suffix) else T.DoubleType()
    return T.StringType()


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All runs of ``sinks.exports.export_run`` as one typed frame: ``run``, the schema's columns, extra ones sorted.

    Runs are grouped by their header, each group is read with that header, and groups are united
    by name; a column that a run does not have is NULL in its rows.  Only file names and one
    header line per run are looked at before the read itself.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    folders = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct().orderBy("folder").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in folders:  # one per run
        groups.setdefault(tuple(header(spark, row["folder"])), []).append(row["folder"])
    if not groups:
        raise ValueError(f"no exported runs in {path}")

    def read(names: tuple[str, ...], held: list[str]) -> DataFrame:
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = spark.read.options(**CSV_OPTIONS, enforceSchema=False, basePath=path).schema(text).csv(held)
        extras = [T.StructField(n, _extra_type(n)) for n in names if n not in schema.names]
        typed = restore_nulls(raw.drop("run"), T.StructType([*schema.fields, *extras]))
        # the run is kept beside: ``restore_nulls`` is row by row
        return restore_nulls(raw, T.StructType([T.StructField("run", T.StringType()), *schema.fields, *extras])).select("run", *typed.columns)

    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (read(n, held) for n, held in groups.items()))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in whole.columns]
    extra = sorted(set(whole.columns) - {"run", *schema.names})
    return whole.select("*", *missing).select("run", *schema.names, *extra)


def read_export(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Exported CSV as a typed frame with NULL restored; extra columns follow.

    All files of the folder must share one header.  Use ``multi_line`` only for
    files with line breaks inside quoted fields: such files are not split.
    """
    names = header(spark, path)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, enforceSchema=False).schema(text).csv(path)
    extras = [T.StructField(n, _extra_type(n)) for n in names if n not in schema.names]
    return restore_nulls(raw, T.StructType([*schema.fields, *extras]))
