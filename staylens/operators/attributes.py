"""Attributes of a property page: category, coordinates, Wi-Fi, scores, counts.

Two inputs give the same columns: the stored page (``page_attributes``, no
shuffle at all) and a table of element rows (``element_attributes``, one
aggregation with map-side combine).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import rules as R
from staylens.functions.markup import first_texts, of_rule, select_elements
from staylens.functions.text import after_last, digits, mapped, safe_double, strip
from staylens.operators.prices import (
    SCAN,
    array_range,
    currency_amounts,
    generic_price,
    price,
    price_tier,
    tier_price,
    tiered_range,
)
from staylens.operators.selection import with_elements


def category(text: Column) -> Column:
    """Second bracketed part from the end, else the only one, else the text."""
    bare = strip(text)
    found = F.regexp_extract_all(bare, F.lit(R.PARENTHESES_PATTERN), 1)
    return F.coalesce(F.try_element_at(found, F.lit(-2)), F.try_element_at(found, F.lit(-1)), bare)


def normal_category(name: Column, table: Mapping[str, str] = R.CATEGORY_MAP) -> Column:
    return mapped(name, table)


def coordinates(html: Column) -> Column:
    """STRUCT<latitude, longitude> of the first pattern that gives two numbers.

    Each pattern goes over the page once; its short match is then read.
    """

    def pair(match: Column, pattern: str) -> Column:
        lat = F.regexp_extract(match, pattern, 1).try_cast("double")
        lon = F.regexp_extract(match, pattern, 2).try_cast("double")
        both = lat.isNotNull() & lon.isNotNull()
        return F.when(both, F.struct(lat.alias("latitude"), lon.alias("longitude")))

    matches = F.array(*[F.regexp_extract(html, p, 0) for p in R.COORDINATE_PATTERNS])
    points = F.transform(matches, lambda m: F.coalesce(*[pair(m, p) for p in R.COORDINATE_PATTERNS]))
    return F.get(F.filter(points, lambda p: p.isNotNull()), F.lit(0))


def guarded(point: Column) -> tuple[Column, Column]:
    """(latitude, longitude), both NULL when either is zero: "not set"."""
    usable = (point["latitude"] != 0) & (point["longitude"] != 0)
    return F.when(usable, point["latitude"]), F.when(usable, point["longitude"])


def wifi_speed(text: Column) -> Column:
    """Text after the last separator of the first speed element."""
    return F.coalesce(after_last(text, R.WIFI_SEPARATOR), F.lit(R.NOT_SPECIFIED))


def score(text: Column) -> Column:
    return safe_double(text)


def review_count(text: Column) -> Column:
    return digits(text)


def subscores(values: Column, positions: Mapping[str, int] = R.SUBSCORE_POSITIONS) -> list[Column]:
    """Named subscores by 1-based position, NULL past the end."""
    return [F.try_element_at(values, F.lit(at)).alias(name) for name, at in positions.items()]


REVIEW_DERIVED = ("general_review", "general_review_count", *R.SUBSCORE_POSITIONS)


def review_gate(properties: DataFrame, has_reviews: Column, columns: tuple[str, ...] = REVIEW_DERIVED) -> DataFrame:
    """Without a review list, everything derived from reviews is NULL."""
    return properties.withColumns({c: F.when(has_reviews, F.col(c)) for c in columns})


def page_attributes(pages: DataFrame, built_in: bool = False) -> DataFrame:
    """Stored property pages -> one attribute row per page; ``html`` is dropped.

    ``built_in`` selects elements by ``selection.with_elements``, without a Python worker but with a
    shuffle of tags; the results are the same.
    ``has_reviews`` tells whether the page shows both a link to reviews and a
    review card; apply ``review_gate`` with it for the review pipeline.
    """
    kept = [f"`{c}`" for c in pages.columns if c != "html"]
    scanned = pages.select(
        *kept, "html", coordinates(F.col("html")).alias("point"), currency_amounts(F.col("html")).alias("scanned")
    )
    if built_in:
        scanned = with_elements(scanned, R.PROPERTY_RULES)
    else:
        scanned = scanned.withColumn("elements", select_elements(F.col("html"), R.PROPERTY_RULES)).drop("html")
    e = F.col("elements")
    generic = [r.name for r in R.PRICE_GENERIC_RULES]
    # The arrays are searched once here; the next step only reads the results.
    picked = scanned.select(
        *kept,
        "point",
        "scanned",
        first_texts(e).alias("first"),
        F.transform(of_rule(e, R.PRICE_PRIMARY_RULE.name), lambda x: price(x["text"])).alias("primary"),
        F.transform(of_rule(e, *generic), lambda x: generic_price(x["text"])).alias("generic"),
        F.transform(of_rule(e, R.SUBSCORE_RULE.name), lambda x: score(x["text"])).alias("scores"),
    )

    def first(rule: str) -> Column:
        return F.try_element_at("first", F.lit(rule))

    def shown(rule: str) -> Column:
        return F.map_contains_key("first", rule)

    low, high = array_range(F.col("primary"), F.col("generic"), F.col("scanned"))
    latitude, longitude = guarded(F.col("point"))
    linked = reduce(or_, [shown(r.name) for r in R.REVIEW_LINK_RULES])
    return picked.select(
        *kept,
        normal_category(category(first(R.CATEGORY_RULE.name))).alias("category"),
        score(first(R.SCORE_RULE.name)).alias("general_review"),
        review_count(first(R.COUNT_RULE.name)).alias("general_review_count"),
        *subscores(F.col("scores")),
        low.alias("min_price"),
        high.alias("max_price"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        wifi_speed(first(R.WIFI_RULE.name)).alias("wifi_speed"),
        F.coalesce(linked & shown(R.REVIEW_CARD_RULE.name), F.lit(False)).alias("has_reviews"),
        F.col("first").isNotNull().alias("readable"),
    )


def element_attributes(elements: DataFrame, key: str = "page_id") -> DataFrame:
    """Element rows ``(key, selector, ordinal, text)`` -> one attribute row per key.

    ``selector`` holds the rule names; a row ``coordinates`` holds the text that
    carries the coordinates and rows ``price_scan`` amounts found in the page.
    """
    selector, ordinal = F.col("selector"), F.col("ordinal")
    numeric = selector.isin(R.SCORE_RULE.name, R.SUBSCORE_RULE.name)
    tier = F.coalesce(price_tier(selector), F.when(selector == "price_scan", SCAN))
    # Texts are read once per row, before the aggregation refers to them often.
    rows = elements.select(key, "selector", "ordinal", "text", tier.alias("tier")).withColumns(
        {
            "number": F.when(numeric, score(F.col("text"))),
            "amount": tier_price(F.col("text"), F.col("tier")),
            "reviews": F.when(selector == R.COUNT_RULE.name, review_count(F.col("text"))),
        }
    )

    def only(rule: str, value: str, at: int = 1) -> Column:
        return F.max(F.when((selector == rule) & (ordinal == at), F.col(value)))

    low, high = tiered_range(F.col("amount"), F.col("tier"))
    merged = rows.groupBy(key).agg(
        only(R.CATEGORY_RULE.name, "text").alias("category_text"),
        only(R.SCORE_RULE.name, "number").alias("general_review"),
        only(R.COUNT_RULE.name, "reviews").alias("general_review_count"),
        *[only(R.SUBSCORE_RULE.name, "number", at).alias(name) for name, at in R.SUBSCORE_POSITIONS.items()],
        low.alias("min_price"),
        high.alias("max_price"),
        only("coordinates", "text").alias("coordinate_text"),
        only(R.WIFI_RULE.name, "text").alias("wifi_text"),
    )
    point = merged.withColumn("point", coordinates(F.col("coordinate_text")))
    latitude, longitude = guarded(F.col("point"))
    return point.select(
        key,
        normal_category(category(F.col("category_text"))).alias("category"),
        "general_review",
        "general_review_count",
        *R.SUBSCORE_POSITIONS,
        "min_price",
        "max_price",
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        wifi_speed(F.col("wifi_text")).alias("wifi_speed"),
    )
