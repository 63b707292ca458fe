"""The property record: key, assembly, column order, export form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.rules import TIMESTAMP_FORMAT
from staylens.functions.text import blank_to_null, number_text
from staylens.operators.links import canonical_url
from staylens.operators.location import locate
from staylens.schemas import BLANK_WHEN_MISSING, RECORD_15, RECORD_31


def stable_id(url: Column) -> Column:
    """Key of a property that a retry or a second run computes again."""
    return F.sha2(canonical_url(url), 256)


def random_id() -> Column:
    """A new key on every evaluation; keep it only if the result is written once."""
    return F.expr("uuid()")


def stamped(pages: DataFrame, run_ts: str, url: str = "url") -> DataFrame:
    """Add ``property_id``, ``property_url`` and the capture time to pages."""
    return pages.withColumns(
        {
            "property_id": stable_id(F.col(url)),
            "property_url": F.col(url),
            "scrape_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    )


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def conform(df: DataFrame, schema: T.StructType, extras: bool = False) -> DataFrame:
    """Exactly the schema's columns in order, absent ones as NULL.

    ``extras=True`` keeps further columns behind them in sorted order.
    """
    present = df.columns
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    more = sorted(set(present) - set(schema.names)) if extras else []
    return df.select(*columns, *more)


def record_15(df: DataFrame) -> DataFrame:
    return conform(df, RECORD_15)


def record_31(df: DataFrame, extras: bool = False) -> DataFrame:
    return conform(df, RECORD_31, extras)


def assemble(attributes: DataFrame, places: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """Attributes, then location by coordinates, then review means by property.

    ``attributes`` and ``reviews`` have one row per ``property_id``; ``places``
    has one row per point.  Rows of ``attributes`` are never lost.
    """
    placed = locate(attributes, places, spread_by="property_id")
    return placed if reviews is None else placed.join(reviews, "property_id", "left")


def export_defaults(record: DataFrame) -> DataFrame:
    """All columns as text: missing names and coordinates '', other missing values '0'."""

    def text(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            shown = timestamp_text(value)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            shown = number_text(value)
        else:
            shown = value.cast("string")
        missing = "" if field.name in BLANK_WHEN_MISSING else "0"
        return F.coalesce(shown, F.lit(missing)).alias(field.name)

    return record.select(*[text(f) for f in record.schema])


def restore_nulls(exported: DataFrame, schema: T.StructType) -> DataFrame:
    """Inverse of ``export_defaults`` for a frame of text columns.

    '0' in a number column and '' in a text column become NULL again.  A number
    that really was 0 cannot be told apart.
    """

    def typed(field: T.StructField) -> Column:
        text = blank_to_null(F.col(field.name))
        if isinstance(field.dataType, T.StringType):
            return text.alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).alias(field.name)
        value = text.try_cast(field.dataType)
        if field.name not in BLANK_WHEN_MISSING:
            value = F.nullif(value, F.lit(0).cast(field.dataType))
        return value.alias(field.name)

    present = exported.columns
    return exported.select(*[typed(f) for f in schema if f.name in present])
