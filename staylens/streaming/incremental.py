"""Incremental operation with Structured Streaming.

Each micro-batch is written before the next begins, so an interrupted run keeps
what it has; the checkpoint makes a restart go on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylens.operators.links import SEEN_ORDER, canonical_url


def _write_batch(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again after a failure replaces its own files.
        (
            (transform(batch) if transform else batch).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append each micro-batch to a Parquet table, once even when it is retried.

    Without ``every`` the query takes all available input and stops.  ``transform`` is
    applied to each batch as a table, for plans that a stream cannot hold.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(_write_batch(path, transform))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def metered_batches(stream: DataFrame, path: str, metrics: str, checkpoint: str, done: Column) -> StreamingQuery:
    """As ``write_batches``, and for each batch a row of ``batch_id``, ``n_done``, ``n_total``, ``percent``.

    The counts are observed while the batch is written, not in a second pass, and are written
    after it, so that a batch with a row of metrics is complete; a batch that is run again replaces both.
    """
    rows = _write_batch(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        rows(batch.observe(seen, F.count(F.when(done, 1)).alias("n_done"), F.count(F.lit(1)).alias("n_total")), batch_id)
        told = seen.get
        percent = round(told["n_done"] * 100 / told["n_total"], 1) if told["n_total"] else 0.0
        row = batch.sparkSession.createDataFrame([(told["n_done"], told["n_total"], percent)], "n_done BIGINT, n_total BIGINT, percent DOUBLE")
        row.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_incremental(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every: str | None = None,
    per_batch: bool = False,
) -> StreamingQuery:
    """Snapshots -> records, flushed per micro-batch.

    ``transform`` may be any row-wise plan, or a stream-static join such as the
    location lookup; with ``per_batch`` any plan at all, since it then gets each batch as a
    table (its windows and aggregates see that batch alone).  The flush size is the source's ``files_per_batch``.
    """
    if per_batch:
        return write_batches(stream, path, checkpoint, every=every, transform=transform)
    return write_batches(transform(stream), path, checkpoint, every=every)


def first_seen_stream(links: DataFrame, order: Sequence[str] = SEEN_ORDER, href: str = "href") -> DataFrame:
    """Links whose canonical URL was not seen in any earlier batch; output mode ``update``.

    An aggregation instead of ``dropDuplicates``: it combines before the
    shuffle, so a hot URL costs one row per task, and inside a batch the first
    href in ``order`` is kept.  State is one row per URL.  Between batches the
    URL that *arrived* first stays, so a stream equals the batch operator when
    files arrive in order.
    """
    rest = [c for c in links.columns if c not in order and c != href]
    seen = (
        links.withColumns({"canonical": canonical_url(F.col(href)), "arrived_at": F.current_timestamp()})
        .groupBy("canonical")
        .agg(
            F.min(F.struct(*order, href, *rest)).alias("first"),
            F.min("arrived_at").alias("first_at"),
            F.max("arrived_at").alias("last_at"),
        )
    )
    return seen.where(F.col("first_at") == F.col("last_at")).select("canonical", "first.*")


def first_seen_within(links: DataFrame, event_time: str, delay: str, href: str = "href") -> DataFrame:
    """First arrival per canonical URL with bounded state, for streams with an event time.

    A URL may come again once ``delay`` has passed.
    """
    return (
        links.withColumn("canonical", canonical_url(F.col(href)))
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark(["canonical"])
    )
