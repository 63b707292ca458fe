"""Proportional stratified interleaving of documents into shards (DataFrame functions only).

Rows of each source are put in a seeded random order.  A row's place in its source, as a
fraction, is its place in the whole: sorting by that fraction interleaves the sources in
proportion, and cutting the sorted rows into equal runs gives shards that all hold the
corpus's mixture, to within a row or two per source.

No rank needs a task that holds a whole source.  A source is split into lanes by the
leading digits of the random key; lanes are counted, a running sum over the counts says
where each lane starts, and rows are numbered inside their lane.  The global order is
numbered the same way, by lanes of the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE = 256
FINE = 256


def _hex_number(digest: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length), 16, 10).cast("long")


def interleave(
    docs: DataFrame,
    shards: int = 40,
    key: str = "doc_id",
    source: str = "source",
    ties: tuple[str, ...] = (),
    seed: str = "1",
) -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0) to every row.

    Shard sizes differ by one row at most.  Rows with the same key are ordered by the
    columns in ``ties``; rows equal in these too are interchangeable.  A NULL source is a
    source of its own, apart from the empty text; NULL keys order as the empty text does.
    Columns of the input named ``shard`` or ``slot`` are replaced, other columns are kept.
    An empty table gives an empty result; with fewer rows than shards some shards are empty.
    """
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    stratum = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        F.struct(*kept).alias("row"),
        stratum.alias("stratum"),
        draw.alias("draw"),
        _hex_number(draw, 1, 4).alias("lane"),
    )
    order = ["draw", *(F.col(f"row.{c}") for c in (key, *ties))]

    lanes = rows.groupBy("stratum", "lane").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("stratum").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.select(
        F.col("stratum").alias("s"),
        F.col("lane").alias("l"),
        F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("total"),
    )
    inside = Window.partitionBy("stratum", "lane").orderBy(*order)
    # a phase of each source's own keeps many small sources from meeting in one place
    phase = _hex_number(F.md5(F.col("stratum").cast("binary")), 1, 8) / F.lit(float(1 << 32))
    placed = (
        rows.withColumn("inside", F.row_number().over(inside) - 1)
        .join(lanes, (F.col("stratum") == F.col("s")) & (F.col("lane") == F.col("l")))
        .withColumn("place", (F.col("before") + F.col("inside") + phase) / F.col("total"))
        .withColumn("bin", F.floor(F.col("place") * (COARSE * FINE)).cast("long"))
        .select("row", "stratum", "draw", "place", "bin")
    )

    bins = placed.groupBy("bin").agg(F.count("*").alias("n"))
    bins = bins.withColumn("coarse", F.expr(f"bin div {FINE}"))
    coarse = bins.groupBy("coarse").agg(F.sum("n").alias("n"))
    everything = Window.orderBy("coarse")  # at most COARSE rows
    coarse = coarse.select(
        F.col("coarse").alias("c"),
        F.coalesce(F.sum("n").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("rows"),
    )
    up_to = Window.partitionBy("coarse").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.join(F.broadcast(coarse), F.col("coarse") == F.col("c")).select(
        F.col("bin").alias("b"),
        (F.col("base") + F.coalesce(F.sum("n").over(up_to), F.lit(0))).alias("start"),
        "rows",
    )
    inside = Window.partitionBy("bin").orderBy("place", "stratum", *order)
    return (
        placed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, F.col("bin") == F.col("b"))
        .withColumn("position", F.col("start") + F.col("inside"))
        .withColumn("shard", F.expr(f"(position * {shards}) div rows").cast("int"))
        .withColumn("slot", F.expr(f"position - (shard * rows + {shards - 1}) div {shards}").cast("long"))
        .select(*(F.col("row")[c].alias(c) for c in kept), "shard", "slot")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (UTF-8 bytes and 16) and ``text_crc32`` of every row.

    A NULL text has no bytes: size 16 and the checksum of nothing, 0.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        "source",
        (F.octet_length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
