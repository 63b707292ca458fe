"""Links seen in earlier runs: Bloom filters in front of stored keys.

A store is a folder with three tables.  ``keys`` holds the links that each run saw first, cut
into buckets by a hash of the canonical URL; ``filters`` one Bloom filter per bucket, sized by
the number of keys; ``runs`` one row per finished run, written last, so that a run that broke
off does not count and is simply run again.

A new run tests its links against the filters of all earlier runs.  Only links that a filter
may hold are compared with stored keys, and only the buckets of such links are read: new links
cost a look at the filters, not a read of everything ever seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.operators.links import SEEN_ORDER, first_seen

BUCKET_KEYS = 100_000  # keys in one bucket, about; its filter is then some 150 KB
BITS_PER_KEY, HASHES = 12, 6  # about one unseen key in 300 is looked up
RUNS = "run INT, n_keys BIGINT, buckets INT, words INT"


def finished_runs(spark: SparkSession, store: str) -> list[Row]:
    """One small row per run of the store; none if there is no store yet."""
    try:
        return spark.read.schema(RUNS).parquet(f"{store}/runs").orderBy("run").collect()
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _places(key: str, words: Column) -> list[Column]:
    """The bits of a key in a filter of that many 64-bit words."""
    bits = words * 64
    first, step = F.pmod(F.xxhash64(F.col(key)), bits), F.pmod(F.xxhash64(F.col(key), F.lit("step")), bits)
    return [((first + step * i) % bits).cast("int") for i in range(HASHES)]


def _bucket(key: str, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit("bucket")), buckets).cast("int")


def _may_hold(filter_words: Column, places: Sequence[Column]) -> Column:
    def is_set(place: Column) -> Column:
        word = F.get(filter_words, F.floor(place / 64).cast("int"))
        return F.call_function("shiftrightunsigned", word, place % 64).bitwiseAND(F.lit(1)) == 1

    return reduce(and_, [is_set(p) for p in places])


def bloom_filters(keys: DataFrame, key: str, buckets: int, words: int) -> DataFrame:
    """``bucket``, ``words``: one Bloom filter per bucket, as an array of 64-bit numbers.

    Bits are combined by a hash aggregate with map-side combine; an array holds ``words`` entries
    whatever the input.
    """
    spark = keys.sparkSession
    place = F.explode(F.array(*_places(key, F.lit(words)))).alias("place")
    hits = keys.select(_bucket(key, F.lit(buckets)).alias("bucket"), place)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)
    hits = hits.select("bucket", F.floor(F.col("place") / 64).cast("int").alias("word"), bit.alias("bits"))
    empty = spark.range(buckets * words).select(
        F.floor(F.col("id") / words).cast("int").alias("bucket"), (F.col("id") % words).cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits")
    )
    filled = hits.unionByName(empty).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return filled.groupBy("bucket").agg(F.transform(ordered, lambda w: w["bits"]).alias("words"))


def maybe_seen(spark: SparkSession, store: str, fresh: DataFrame, runs: Sequence[Row], key: str = "canonical") -> DataFrame:
    """``key``, ``run``, ``bucket`` of the keys that the filter of a run may hold; filters are read, keys are not."""
    told = F.explode(F.array(*(F.struct(*(F.lit(r[c]).alias(c) for c in ("run", "buckets", "words"))) for r in runs))).alias("r")
    asked = fresh.select(key, told).select(key, "r.run", _bucket(key, F.col("r.buckets")).alias("bucket"), "r.words")
    asked = asked.withColumnRenamed("words", "n_words")
    filters = spark.read.option("basePath", f"{store}/filters").parquet(*(f"{store}/filters/run={r['run']}" for r in runs))
    filters = filters.select(F.col("run").alias("filter_run"), F.col("bucket").alias("filter_bucket"), F.col("words").alias("filter_words"))
    here = (F.col("run") == F.col("filter_run")) & (F.col("bucket") == F.col("filter_bucket"))
    held = _may_hold(F.col("filter_words"), _places(key, F.col("n_words")))
    return asked.join(filters, here & held, "left_semi").select(key, "run", "bucket")


def stored_keys(spark: SparkSession, store: str, buckets: Sequence[Row]) -> DataFrame:
    """The stored links of some buckets (``run``, ``bucket``); no other bucket is read."""
    return spark.read.option("basePath", f"{store}/keys").parquet(
        *(f"{store}/keys/run={b['run']}/bucket={b['bucket']}" for b in buckets)
    )


def unseen(spark: SparkSession, store: str, fresh: DataFrame, run: int, key: str = "canonical") -> DataFrame:
    """The rows of ``fresh`` whose key no run before ``run`` has seen."""
    runs = [r for r in finished_runs(spark, store) if r["run"] < run and r["n_keys"]]
    if not runs:
        return fresh
    maybe = stored(maybe_seen(spark, store, fresh, runs, key), "maybe-seen")
    buckets = maybe.select("run", "bucket").distinct().collect()  # as many as there are buckets, at most
    if not buckets:
        return fresh
    seen = stored_keys(spark, store, buckets).select("run", "bucket", key).join(maybe, ["run", "bucket", key], "left_semi")
    return fresh.join(seen.select(key), key, "left_anti")


def add_run(
    store: str, links: DataFrame, run: int, order: Sequence[str] = SEEN_ORDER, bucket_keys: int = BUCKET_KEYS
) -> DataFrame:
    """The links of a run that no earlier run has seen, one row per canonical URL, added to the store.

    Runs have ascending numbers.  A run that is run again replaces itself and looks at the runs
    before it only, so that a retry gives the same rows.  Within a run the first link in
    ``order`` stays.  Links without a URL are one key, NULL, and are not kept.
    """
    spark = links.sparkSession
    fresh = stored(first_seen(links, order).where(F.col("canonical").isNotNull()), "fresh-links")
    new = stored(unseen(spark, store, fresh, run), "new-links")
    n = new.count()
    buckets = max(-(-n // bucket_keys), 1)
    words = -(-n // buckets) * BITS_PER_KEY // 64 + 1
    dealt = new.withColumn("bucket", _bucket("canonical", F.lit(buckets)))
    dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/keys/run={run}")
    bloom_filters(new, "canonical", buckets, words).write.mode("overwrite").parquet(f"{store}/filters/run={run}")
    told = spark.createDataFrame([(n, buckets, words)], "n_keys BIGINT, buckets INT, words INT").coalesce(1)
    told.write.mode("overwrite").parquet(f"{store}/runs/run={run}")
    return new


def compact(spark: SparkSession, store: str, into: str, bucket_keys: int = BUCKET_KEYS) -> int:
    """Write all runs of a store as one run of a new store, under the last run's number; returns the number of keys.

    Runs have no key in common, so that their keys are simply laid together.
    """
    runs = finished_runs(spark, store)
    if not runs:
        return 0
    links = spark.read.option("basePath", f"{store}/keys").parquet(*(f"{store}/keys/run={r['run']}" for r in runs))
    new = links.drop("run", "bucket")
    n = sum(r["n_keys"] for r in runs)
    run, buckets = runs[-1]["run"], max(-(-n // bucket_keys), 1)
    words = -(-n // buckets) * BITS_PER_KEY // 64 + 1
    dealt = new.withColumn("bucket", _bucket("canonical", F.lit(buckets)))
    dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{into}/keys/run={run}")
    bloom_filters(new, "canonical", buckets, words).write.mode("overwrite").parquet(f"{into}/filters/run={run}")
    told = spark.createDataFrame([(n, buckets, words)], "n_keys BIGINT, buckets INT, words INT").coalesce(1)
    told.write.mode("overwrite").parquet(f"{into}/runs/run={run}")
    return n
