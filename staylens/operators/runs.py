"""Run names, progress and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from staylens.functions.rules import RUN_STAMP_FORMAT


def run_name(cities: Column, started: Column) -> Column:
    """``city-city_yyyyMMdd_HHmmss`` in lower case from an ordered array of cities."""
    return F.concat_ws("_", F.lower(F.array_join(cities, "-")), F.date_format(started, RUN_STAMP_FORMAT))


def run_names(runs: DataFrame, run: Sequence[str], seq: str = "dest_seq", city: str = "city") -> DataFrame:
    """One name per run from its rows ``(run.., dest_seq, city, started)``.

    A name holds every city of its run, so a run is as long as a name may be.
    """
    ordered = F.array_sort(F.collect_list(F.struct(seq, city)))
    named = runs.groupBy(*run).agg(ordered.alias("cities"), F.min("started").alias("started"))
    cities = F.transform("cities", lambda c: c[city])
    return named.select(*run, F.size("cities").alias("n_cities"), run_name(cities, F.col("started")).alias("run_id"))


DIGEST_BITS = 60


def run_keys(runs: DataFrame, run: Sequence[str], seq: str = "dest_seq", city: str = "city") -> DataFrame:
    """As ``run_names`` for runs of any length: first and last city, a digest of all, and the time.

    The digest adds up a hash of each city with its place, so that it depends on the order of the
    cities, is combined before the shuffle, and no row holds a run's cities; they stay rows.
    """
    place = F.concat_ws("|", F.col(seq).cast("string"), F.lower(F.col(city)))
    hashed = F.conv(F.substring(F.md5(place.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("decimal(38,0)")
    ends = F.struct(seq, city)
    told = runs.groupBy(*run).agg(
        F.count("*").cast("int").alias("n_cities"),
        F.min(ends)[city].alias("first_city"),
        F.max(ends)[city].alias("last_city"),
        F.lower(F.hex(F.pmod(F.sum(hashed), F.lit(1 << DIGEST_BITS).cast("decimal(38,0)")).cast("bigint"))).alias("digest"),
        F.min("started").alias("started"),
    )
    name = F.concat_ws("_", F.lower(F.concat_ws("-", "first_city", "last_city")), "digest", F.date_format("started", RUN_STAMP_FORMAT))
    return told.select(*run, "n_cities", "first_city", "last_city", "digest", name.alias("run_id"))


def run_summary(rows: DataFrame, run: str, done: Column) -> DataFrame:
    """Per run: rows done, all rows, percent with one decimal."""
    counted = rows.groupBy(run).agg(F.count(F.when(done, 1)).alias("n_done"), F.count("*").alias("n_total"))
    return counted.withColumn("percent", F.round(F.col("n_done") * 100 / F.col("n_total"), 1))


def observed(df: DataFrame, observation: Observation, url: str = "property_url") -> DataFrame:
    """Count rows while they are written, without a second pass."""
    return df.observe(
        observation,
        F.count("*").alias("n_rows"),
        F.count(F.when(F.col(url).isNull(), 1)).alias("n_without_url"),
    )


def rejected(df: DataFrame, mandatory: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows that lack a mandatory field, with the reason; the run goes on."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in mandatory]))
    reason = F.concat(F.lit("missing "), F.array_join(missing, ", "))
    bad = df.select(*keep, F.when(F.size(missing) > 0, reason).alias("reason"))
    return bad.where(F.col("reason").isNotNull())
