"""Rows of a large table that are wanted by a hash, told at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.rows import columns_of, unused

SLOTS = 1 << 25  # bits that wanted hashes are marked in: 1,024 rows of 4 KB, whatever is wanted
BITMAP = 1 << 15  # bits of Spark's bitmaps


def marked_rows(table: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose hash ``column`` (BIGINT) is in ``wanted``, and a few others.

    The wanted hashes are marked in bitmaps of four megabytes together, which are small enough
    to be broadcast, so that rows nobody wants are dropped where they are read and never
    shuffled.  With more than some million wanted hashes the marks let ever more other
    rows pass, up to all; a caller must join with what it wants in the end.
    """
    mark = unused(table, "marked")
    return with_marks(table, column, wanted, mark, "inner").where(mark).drop(mark)


def with_marks(table: DataFrame, column: str, wanted: DataFrame, name: str, how: str = "left") -> DataFrame:
    """``table`` with the boolean ``name``: false only where the hash ``column`` (BIGINT) is not in ``wanted``.

    Bitmaps as of ``marked_rows``.  ``inner`` leaves out some rows whose hash is not in ``wanted``.
    """
    slot = F.pmod(F.col(column), F.lit(SLOTS))
    marks = wanted.select(slot.alias("slot"))
    marks = marks.groupBy((F.col("slot") / BITMAP).cast("int").alias("page")).agg(
        F.bitmap_construct_agg(F.pmod("slot", F.lit(BITMAP))).alias("bits")
    )
    page, bits = unused(table, "page"), unused(table, "bits")
    place = F.pmod(F.col(column), F.lit(BITMAP)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return (
        table.withColumn(page, (slot / BITMAP).cast("int"))
        .join(F.broadcast(marks.toDF(page, bits)), page, how)
        .select(*columns_of(table), F.coalesce(marked, F.lit(False)).alias(name))
    )
