"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # rankings limit inside each task for every limit, not for small ones only
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # one state row per URL ever seen does not have to fit in memory
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def builder(app: str = "staylens") -> SparkSession.Builder:
    """A builder with the library's settings.

    Shuffle partitions, memory and ``spark.checkpoint.dir`` are the cluster's
    business and are left alone.  Arrow batches are small because their rows are
    whole pages.
    """
    made = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        made = made.config(name, value)
    return made
