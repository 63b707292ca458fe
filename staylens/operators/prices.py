"""Prices: three sources tried in turn, then minimum and maximum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.rules import CURRENCY_PATTERN, PRICE_GENERIC_RULES, PRICE_PRIMARY_RULE
from staylens.functions.text import ascii_digits, decimals, digits, unicode_pattern

PRIMARY, GENERIC, SCAN = 1, 2, 3


def price(text: Column) -> Column:
    """Digits joined: decimals are not separated, as in the listings' own markup."""
    return digits(text)


def generic_price(text: Column) -> Column:
    """As ``price``, but superscripts and the like are skipped instead of spoiling the text."""
    return decimals(text)


def tier_price(text: Column, tier: Column) -> Column:
    return F.when(tier == PRIMARY, price(text)).when(tier.isNotNull(), generic_price(text))


def currency_amounts(html: Column) -> Column:
    """Amounts of two to five digits after a currency sign, over the whole page."""
    found = F.regexp_extract_all(html, F.lit(unicode_pattern(CURRENCY_PATTERN)), 1)
    return F.transform(found, lambda t: ascii_digits(t).try_cast("bigint"))


def price_tier(selector: Column) -> Column:
    """Tier of an element row by the name of its rule, NULL for other rules."""
    generic = [r.name for r in PRICE_GENERIC_RULES]
    return F.when(selector == PRICE_PRIMARY_RULE.name, PRIMARY).when(selector.isin(*generic), GENERIC)


def tiered_range(amount: Column, tier: Column) -> tuple[Column, Column]:
    """Aggregates (min, max) over the lowest tier that has an amount.

    One min and max per tier, so the tiers need neither a window nor a join.
    """
    lows = [F.min(F.when(tier == t, amount)) for t in (PRIMARY, GENERIC, SCAN)]
    highs = [F.max(F.when(tier == t, amount)) for t in (PRIMARY, GENERIC, SCAN)]
    return F.coalesce(*lows), F.coalesce(*highs)


def price_range(prices: DataFrame, key: str, tier: str = "tier", amount: str = "amount") -> DataFrame:
    low, high = tiered_range(F.col(amount), F.col(tier))
    return prices.groupBy(key).agg(low.alias("min_price"), high.alias("max_price"))


def array_range(*tiers: Column) -> tuple[Column, Column]:
    """Same choice on arrays of amounts held by one row."""
    return (
        F.coalesce(*[F.array_min(t) for t in tiers]),
        F.coalesce(*[F.array_max(t) for t in tiers]),
    )
