"""Means per traveller type that grow batch by batch.

What a batch of cards adds is one row per property and raw type: an exact decimal sum, a count
and the first sighting.  Such rows can be merged in any order and grouping, so that the state is
a table to which each batch writes its own folder, and any number of batches give the same bits
as one pass over all cards.  (Scores that fit no decimal of eight places are added as
DOUBLE beside; for them the last digit may depend on the order.)

Batches are merged into a base now and then.  A base says up to which batch it goes; it counts
from the moment its row in ``bases`` is written, and batches it holds are then not read again.
A review cap cannot be kept batch by batch, since a later batch may hold newer cards: cap
before, by page number, or read all cards.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylens.functions.stats import total
from staylens.operators import reviews as V
from staylens.plans.reviews import raw_type_stats

PARTS = ("sum_exact", "sum_other", "n", "first_seen")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def merged(parts: DataFrame) -> DataFrame:
    """Partial rows of any batches -> one row per property and raw type, with map-side combine."""
    added = parts.groupBy(V.KEY, "traveler_type").agg(
        F.sum("sum_exact").cast("decimal(38,8)").alias("sum_exact"),
        F.sum("sum_other").alias("sum_other"),
        F.sum("n").alias("n"),
        F.min("first_seen").alias("first_seen"),
    )
    return added.withColumn("avg_score", total(F.col("sum_exact"), F.col("sum_other")) / F.col("n"))


def add_batch(store: str, cards: DataFrame, batch: int, target_year: int | None = None, offered: DataFrame | None = None) -> None:
    """Add a batch of cards to the state.  A batch that is added again replaces itself."""
    stats = raw_type_stats(cards, target_year, offered=offered)
    stats.select(V.KEY, "traveler_type", *PARTS).write.mode("overwrite").parquet(f"{store}/batches/batch={batch}")


def _base(spark: SparkSession, store: str) -> int | None:
    bases = _read(spark, f"{store}/bases")
    return None if bases is None else bases.agg(F.max("upto")).first()[0]


def _parts(spark: SparkSession, store: str) -> DataFrame | None:
    upto, batches = _base(spark, store), _read(spark, f"{store}/batches")
    if upto is None:
        return None if batches is None else batches.drop("batch")
    base = spark.read.parquet(f"{store}/merged/upto={upto}")
    return base if batches is None else base.unionByName(batches.where(F.col("batch") > upto).drop("batch"))


def state(spark: SparkSession, store: str) -> DataFrame:
    """Means, counts and first sighting per property and raw type over all batches added so far."""
    parts = _parts(spark, store)
    if parts is None:
        raise ValueError(f"no batch has been added to {store}")
    return merged(parts)


def compact(spark: SparkSession, store: str, upto: int) -> None:
    """Merge all batches up to a number into a base; every batch up to it must have been added."""
    now = _base(spark, store)
    if now is not None and now >= upto:
        return
    batches = spark.read.parquet(f"{store}/batches").where(F.col("batch") <= upto)
    if now is not None:
        batches = batches.where(F.col("batch") > now).drop("batch").unionByName(spark.read.parquet(f"{store}/merged/upto={now}"))
    made = merged(batches).select(V.KEY, "traveler_type", *PARTS)
    made.write.mode("overwrite").parquet(f"{store}/merged/upto={upto}")
    spark.createDataFrame([(upto,)], "upto BIGINT").coalesce(1).write.mode("append").parquet(f"{store}/bases")


def means_stream(
    cards: DataFrame,
    store: str,
    checkpoint: str,
    target_year: int | None = None,
    compact_every: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Add each micro-batch of a stream of cards to the state; merge batches into a base each ``compact_every``.

    Without ``every`` the query takes all available input and stops.
    """

    def add(batch: DataFrame, number: int) -> None:
        add_batch(store, batch, number, target_year)
        if compact_every and number % compact_every == compact_every - 1:
            compact(batch.sparkSession, store, number)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return cards.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()
