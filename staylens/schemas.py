"""Schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from staylens.functions.rules import TRAVELER_TYPES

DESTINATIONS = "dest_seq INT, city STRING"
PAGES = "page_id BIGINT, url STRING, html STRING"
SEARCH_VIEWS = "dest_seq INT, scroll_no INT, html STRING"
LINKS = "dest_seq INT, scroll_no INT, pos INT, href STRING"
PAGE_ELEMENTS = "page_id BIGINT, selector STRING, ordinal INT, text STRING, attr STRING"
REVIEW_PAGES = "property_id STRING, list_kind STRING, page_no INT, html STRING"
REVIEW_CARDS = (
    "property_id STRING, list_kind STRING, review_ts TIMESTAMP, review_id BIGINT, "
    "page_no INT, pos INT, score_text STRING, stay_date STRING, traveler_type STRING"
)
OFFERED_LISTS = "property_id STRING, list_kind STRING"
GEOCODES = "lat DOUBLE, lon DOUBLE, body STRING"
GEOCODE_BODY = "display_name STRING, address MAP<STRING,STRING>"


def mean_column(kind: str) -> str:
    return f"avg_review_score_{kind}"


def count_column(kind: str) -> str:
    return f"avg_review_score_{kind}_count"


def _fields(*specs: tuple[str, T.DataType]) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name, kind in specs]


# --- fixed values: columns of the two record forms, in order -----------------
_STR, _DBL, _INT = T.StringType(), T.DoubleType(), T.LongType()

_PLACE = _fields(
    ("min_price", _INT),
    ("max_price", _INT),
    ("latitude", _DBL),
    ("longitude", _DBL),
    ("address", _STR),
    ("zone", _STR),
    ("city", _STR),
    ("wifi_speed", _STR),
)

RECORD_15 = T.StructType(
    _fields(
        ("property_id", _STR),
        ("scrape_timestamp", T.TimestampType()),
        ("property_url", _STR),
        ("category", _STR),
        ("general_review", _DBL),
        ("general_review_count", _INT),
        ("wifi_score", _DBL),
    )
    + _PLACE
)

RECORD_31 = T.StructType(
    _fields(
        ("property_id", _STR),
        ("scrape_timestamp", T.TimestampType()),
        ("filtered_year", T.IntegerType()),
        ("property_url", _STR),
        ("category", _STR),
        ("general_review", _DBL),
        ("general_review_count", _INT),
        ("comfort_score", _DBL),
        ("value_score", _DBL),
        ("location_score", _DBL),
        ("wifi_score", _DBL),
    )
    + [
        field
        for kind in ("all", *TRAVELER_TYPES)
        for field in _fields((mean_column(kind), _DBL), (count_column(kind), _INT))
    ]
    + _PLACE
)

# Columns exported as '' when missing; every other missing value becomes '0'.
BLANK_WHEN_MISSING = (
    "property_url",
    "category",
    "latitude",
    "longitude",
    "address",
    "zone",
    "city",
    "wifi_speed",
)
