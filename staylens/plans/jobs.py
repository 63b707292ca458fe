"""End-to-end jobs over stored tables, for ``spark-submit``.

    spark-submit --py-files staylens.zip job.py short   --pages .. --geocodes .. --out ..
    spark-submit --py-files staylens.zip job.py reviews --pages .. --geocodes .. --cards .. --year 2025 --out ..

where ``job.py`` calls ``staylens.plans.jobs.main``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.operators.links import canonical_url
from staylens.plans.discovery import discover
from staylens.plans.records import base_records, review_records, short_records
from staylens.schemas import OFFERED_LISTS
from staylens.session import builder
from staylens.sinks.exports import export_csv, write_records
from staylens.sources import tables


def listing_pages(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Stored pages of the discovered links, under the link's full URL.

    The links are stored first, so that the planner knows their size: it sends
    a small set to every task, and page texts are then filtered where they are
    read.  Of several captures of a listing the one with the highest ``page_id``
    is used.
    """
    wanted = stored(links.select("canonical", F.col("href").alias("url")), "listings")
    captures = pages.withColumn("canonical", canonical_url(F.col("url"))).drop("url")
    latest = (
        captures.select("canonical", "page_id")
        .join(wanted, "canonical")
        .groupBy("canonical", "url")
        .agg(F.max("page_id").alias("page_id"))
    )
    return captures.select("page_id", "html").join(latest, "page_id")


def run(
    spark: SparkSession,
    kind: str,
    out: str,
    pages: str,
    geocodes: str,
    run_id: str,
    run_ts: str,
    views: str | None = None,
    cards: str | None = None,
    year: int | None = None,
    limit: int | None = None,
    csv: str | None = None,
    offered: str | None = None,
    all_types: bool = False,
    page_limit: int | None = None,
    base: str | None = None,
) -> DataFrame:
    """Build the records of one run, store them as Parquet and return the stored rows.

    ``limit`` and ``page_limit`` cap links and review pages; by default nothing is capped.
    """
    snapshots = tables.pages(spark, pages)
    if views:
        snapshots = listing_pages(snapshots, discover(tables.search_views(spark, views), limit, base=base))
    base, places = base_records(snapshots, run_ts), tables.geocodes(spark, geocodes)
    if kind == "reviews":
        lists = spark.read.schema(OFFERED_LISTS).parquet(offered) if offered else None
        records = review_records(base, places, tables.review_cards(spark, cards), year, page_limit, lists, all_types)
    else:
        records = short_records(base, places)
    write_records(records, out, run_id)
    written = spark.read.parquet(out).where(F.col("run_id") == run_id).drop("run_id")
    if csv:
        export_csv(written, csv)
    return written


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build property records from stored snapshots")
    parser.add_argument("kind", choices=("short", "reviews"))
    for name in ("pages", "geocodes", "out", "run-id", "run-ts"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("views", "cards", "csv", "offered", "base"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--year", type=int)
    parser.add_argument("--limit", type=int)
    parser.add_argument("--page-limit", type=int)
    parser.add_argument("--all-types", action="store_true")
    args = vars(parser.parse_args(argv))
    if args["kind"] == "reviews" and not args["cards"]:
        parser.error("reviews need --cards")
    spark = builder().getOrCreate()
    run(spark, **args)
