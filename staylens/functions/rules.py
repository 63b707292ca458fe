"""The selectors, patterns and lookup tables that decide results.

Everything here is data.  All of it can be replaced by arguments of the
operators that use it.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """One element rule.

    ``css`` selects elements (descendant and child combinators, tag, ``#id``,
    ``.class``, ``[a]``, ``[a=v]``, ``[a*=v]``, ``:not([..])`` and
    ``:nth-of-type(n)``); ``own_text`` must occur in the first text node of the
    element; ``attr`` names the attribute to return beside the text.
    """

    name: str
    css: str
    attr: str | None = None
    own_text: str | None = None


# --- fixed values: search request -----------------------------------------
SEARCH_PARAMETERS = (
    ("group_adults", "1"),
    ("no_rooms", "1"),
    ("group_children", "0"),
)

# --- fixed values: link rules, first match wins ----------------------------
LINK_RULES = (
    Rule("1", 'a[data-testid="title-link"]', "href"),
    Rule("2", 'h3[data-testid="title"] > a', "href"),
    Rule("3", 'div[data-testid="property-card"] a[href*="/hotel/"]', "href"),
    Rule("4", 'a[class*="e13098a59f"][href*="/hotel/"]', "href"),
    Rule("5", 'a[href*="/hotel/"]:not([href*="#"])', "href"),
    Rule("6", 'div[class*="sr_property_block"] a[class*="hotel_name_link"]', "href"),
    Rule("7", 'a[class*="js-sr-hotel-link"]', "href"),
)
LINK_NEEDLE = "/hotel/"

# --- fixed values: page state ----------------------------------------------
BLOCKED_TOKENS = ("captcha", "verify")
EMPTY_TOKENS = ("no properties found", "no results")

# --- fixed values: property page rules --------------------------------------
PRICE_PRIMARY_RULE = Rule(
    "price_primary",
    "td.hprt-table-cell-price div.hprt-price-block div.prco-wrapper span.prco-valign-middle-helper",
)
PRICE_GENERIC_RULES = (
    Rule(
        "price_generic_1",
        "td.hp-price-left-align.hprt-table-cell.hprt-table-cell-price div.hprt-price-block span.prc-no-css",
    ),
    Rule("price_generic_2", "td.hprt-table-cell-price span.prc-no-css"),
    Rule("price_generic_3", "div.hprt-price-block span.prc-no-css"),
    Rule("price_generic_4", "span[data-testid='price-and-discounted-price']"),
    Rule("price_generic_5", "div[data-testid='price-and-discounted-price']"),
    Rule("price_generic_6", "span.hprt-price-price-standard"),
    Rule("price_generic_7", "span.fcab3ed991.bd73d13072"),
)
CATEGORY_RULE = Rule("category", 'span[data-testid="breadcrumb-current"] span')
WIFI_RULE = Rule("wifi", "div", own_text="Mbps")
SCORE_RULE = Rule("score", "#js--hp-gallery-scorecard > a > div > div > div > div:nth-of-type(2)")
COUNT_RULE = Rule(
    "count",
    "#js--hp-gallery-scorecard > a > div > div > div > div:nth-of-type(4) > div:nth-of-type(2)",
)
SUBSCORE_RULE = Rule("subscore", 'div[data-testid="review-subscore"] div[aria-hidden="true"]')
REVIEW_LINK_RULES = (
    Rule("review_link_1", "#js--hp-gallery-scorecard"),
    Rule("review_link_2", "a[data-testid='see-all-reviews-link']"),
    Rule("review_link_3", "a[href*='#tab-reviews']"),
)
REVIEW_CARD_RULE = Rule("review_card", '[data-testid="review-card"]')
PROPERTY_RULES = (
    PRICE_PRIMARY_RULE,
    *PRICE_GENERIC_RULES,
    CATEGORY_RULE,
    WIFI_RULE,
    SCORE_RULE,
    COUNT_RULE,
    SUBSCORE_RULE,
    *REVIEW_LINK_RULES,
    REVIEW_CARD_RULE,
)

# --- fixed values: rules inside one review card -----------------------------
CARD_RULES = (
    Rule("card_score", "div", own_text="Scored"),
    Rule("card_stay_date", '[data-testid="review-stay-date"]'),
    Rule("card_traveler_type", '[data-testid="review-traveler-type"]'),
)

# --- fixed values: text patterns --------------------------------------------
SCORE_MARKER = "Scored "
YEAR_PATTERN = r"\b(20\d{2})\b"
CURRENCY_PATTERN = r"[€$£]\s?(\d{2,5})"
PARENTHESES_PATTERN = r"\(([^)]+)\)"
COORDINATE_PATTERNS = (
    r'"latitude":([0-9\.\-]+),"longitude":([0-9\.\-]+)',
    r'"lat":([0-9\.\-]+),"lng":([0-9\.\-]+)',
)
NON_LATIN_PATTERN = r"[^a-zA-Z0-9\s\-,\.']"
WIFI_SEPARATOR = "•"
NOT_SPECIFIED = "Not specified"
UNKNOWN = "Unknown"

# --- fixed values: positions in the flattened subscore list (1-based) --------
SUBSCORE_POSITIONS = {
    "comfort_score": 4,
    "value_score": 5,
    "location_score": 6,
    "wifi_score": 7,
}

# --- fixed values: location fields, first usable one wins --------------------
ZONE_FIELDS = ("neighbourhood", "suburb", "quarter", "city_district", "district")
CITY_FIELDS = ("city", "town", "municipality", "village")

# --- fixed values: names ------------------------------------------------------
CATEGORY_MAP = {
    "Guest House": "Riad",
    "Condo Hotel": "Apartment-Hotel",
}
TRAVELER_TYPE_MAP = {
    "couple": "couples",
    "group": "groups_friends",
    "solo_traveler": "solo_travelers",
    "solo_traveller": "solo_travelers",
    "group_of_friends": "groups_friends",
    "families": "families",
    "family": "families",
    "business_traveller": "business_travellers",
    "business_traveler": "business_travellers",
}
TRAVELER_TYPES = (
    "families",
    "couples",
    "solo_travelers",
    "business_travellers",
    "groups_friends",
)
ALL_LIST = "ALL"
BUSINESS_LIST = "BUSINESS_TRAVELLERS"
BUSINESS_RAW_TYPE = "Business travellers"

# --- fixed values: limits and formats ------------------------------------------
REVIEW_PAGE_SIZE = 10
HEAD_CHARACTERS = 10_000
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RUN_STAMP_FORMAT = "yyyyMMdd_HHmmss"
