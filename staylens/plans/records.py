"""Property records: the short form (15 columns) and the review form (31 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators.attributes import REVIEW_DERIVED, page_attributes, review_gate
from staylens.operators.location import locations
from staylens.operators.record import assemble, record_15, record_31, stamped
from staylens.operators.reviews import reviewed_properties
from staylens.plans.reviews import traveler_means, traveler_means_all_types
from staylens.schemas import RECORD_31


def base_records(pages: DataFrame, run_ts: str) -> DataFrame:
    """Property pages -> key, capture time, URL and attributes; ``html`` is gone."""
    return page_attributes(stamped(pages, run_ts))


def short_records(base: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Attribute rows and geocoder responses -> 15-column records."""
    return record_15(assemble(base, locations(geocodes)))


def review_records(
    base: DataFrame,
    geocodes: DataFrame,
    cards: DataFrame,
    target_year: int | None = None,
    page_limit: int | None = None,
    offered: DataFrame | None = None,
    all_types: bool = False,
) -> DataFrame:
    """Attribute rows, geocoder responses and review cards -> 31-column records.

    A property without any card (or, where ``base`` says so, without a review
    link) has no review-derived values.  With ``all_types``, further traveller
    types follow as extra columns in sorted order.  ``cards`` is read once for
    the means and once, its key column only, for the gate: give it a stored table.
    """
    means = (traveler_means_all_types if all_types else traveler_means)(cards, target_year, page_limit, offered)
    scores = tuple(c for c in means.columns if c != "property_id")
    reviews = reviewed_properties(cards).join(means, "property_id", "left").withColumn("carded", F.lit(True))
    placed = assemble(base, locations(geocodes), reviews)
    has_reviews = F.coalesce("carded", F.lit(False))
    if "has_reviews" in base.columns:
        has_reviews = has_reviews & F.col("has_reviews")
    gated = review_gate(placed, has_reviews, (*REVIEW_DERIVED, *scores))
    dated = gated.withColumn("filtered_year", F.lit(target_year or None).cast("int"))
    known = (*RECORD_31.names, *scores)
    return record_31(dated.select(*[c for c in dated.columns if c in known]), extras=all_types)
