"""Plans that have to keep their shape, checked without running them."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import location, reviews
from staylens.plans.queries import QUERIES
from staylens.plans.reviews import kept_cards

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_top_k_is_one_plan_for_every_k(spark):
    """Days are counted and cards ranked inside their day, limited before the shuffle, for any k."""
    cards = spark.createDataFrame([], schemas.REVIEW_CARDS)
    for pages in (2, 500):
        text = plan(reviews.newest_k(cards, pages))
        assert text.count("WindowGroupLimit") == 2 and "lane" in text and "CartesianProduct" not in text
    assert "WindowGroupLimit" not in plan(reviews.newest_k(cards))


def test_first_seen_combines_before_the_shuffle(spark):
    text = plan(QUERIES["first_seen_links"](spark, SF))
    assert "partial_min" in text and text.count("Exchange") == 1


def test_price_range_is_one_hash_aggregation(spark):
    text = plan(QUERIES["price_min_max"](spark, SF))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2 and "Window" not in text


def test_page_extraction_does_not_shuffle(spark):
    text = plan(QUERIES["page_elements"](spark, SF))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text


def test_page_cap_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([], schemas.REVIEW_CARDS).write.parquet(str(tmp_path / "c"))
    cards = spark.read.schema(schemas.REVIEW_CARDS).parquet(str(tmp_path / "c"))
    text = plan(reviews.type_stats(kept_cards(cards, 2025, 20)))
    assert "LessThanOrEqual(page_no,20)" in text and "Window" not in text
    assert "review_ts" not in text.split("ReadSchema")[1]


def test_year_partitions_are_pruned(spark, tmp_path):
    raw = spark.createDataFrame(
        [("p", "ALL", None, n, 1, n, "Scored 5", d, "Couple") for n, d in enumerate(["2024", "2025", None])], schemas.REVIEW_CARDS
    )
    reviews.parse_cards(raw).write.partitionBy("stay_year").parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    kept = stored.where((F.col("list_kind") == "BUSINESS_TRAVELLERS") & reviews.strict_year(2025))
    assert "PartitionFilters: [isnotnull(stay_year" in plan(kept) or "PartitionFilters: [coalesce" in plan(kept)


def test_small_lookup_is_broadcast_by_size_and_large_is_not(spark):
    geocodes = spark.createDataFrame([(1.0, 1.0, "{}")], schemas.GEOCODES)
    small = spark.createDataFrame([("a", 1.0, 1.0)], "property_id string, latitude double, longitude double")
    assert "ResolvedHint" not in plan(location.locate(small, geocodes.select("lat", "lon"), "property_id"))


def test_no_query_uses_a_cross_join(spark):
    for name in ("property_record", "record_15", "visited_views", "geo_lookup_join", "run_id"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
