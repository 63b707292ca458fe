"""Crawl quality: page state, destination coverage, which views count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.rules import BLOCKED_TOKENS, EMPTY_TOKENS
from staylens.functions.text import contains_any


def page_state(
    text: Column,
    blocked: tuple[str, ...] = BLOCKED_TOKENS,
    empty: tuple[str, ...] = EMPTY_TOKENS,
) -> Column:
    """``blocked``, ``empty`` or ``ok``; a blocked page is never called empty."""
    lower = F.lower(text)
    return (
        F.when(contains_any(lower, blocked), "blocked")
        .when(contains_any(lower, empty), "empty")
        .otherwise("ok")
    )


def state_counts(pages: DataFrame, text: str, **tokens: tuple[str, ...]) -> DataFrame:
    return (
        pages.select(page_state(F.col(text), **tokens).alias("state"))
        .groupBy("state")
        .agg(F.count("*").alias("n_pages"))
    )


def destination_coverage(destinations: DataFrame, links: DataFrame) -> DataFrame:
    """Links found per destination, 0 for those with none.

    Links are counted before the join, so a destination with most of the links
    costs one row.
    """
    counts = links.groupBy("dest_seq").agg(F.count("*").alias("n_links"))
    found = F.coalesce("n_links", F.lit(0))
    return destinations.join(counts, "dest_seq", "left").select(
        "dest_seq", "city", found.alias("n_links"), (found > 0).alias("covered")
    )


def visited_views(views: DataFrame, max_views: int | None = None, patience: int | None = None) -> DataFrame:
    """The views whose links count, from ``views(dest_seq, scroll_no, matched, state, n_links)``.

    A view without any rule match on an ``empty`` page is the last one of its
    destination.  With ``max_views``, no later view counts; with ``patience``,
    while nothing has been collected from any destination, a destination is left
    after that many views and one more.  Both paced a live browser; stored views
    have no need of them.
    """
    first_empty = F.min(F.when(~F.col("matched") & (F.col("state") == "empty"), F.col("scroll_no")))
    stops = views.groupBy("dest_seq").agg(first_empty.alias("stop"))
    within = (views.where(F.col("scroll_no") <= max_views) if max_views else views).join(stops, "dest_seq")
    within = within.where(F.col("stop").isNull() | (F.col("scroll_no") <= F.col("stop"))).drop("stop")
    if patience is None:
        return within
    early = F.col("scroll_no") <= patience + 1
    success = within.where(early & (F.col("n_links") > 0)).agg(F.min("dest_seq")).scalar()
    return within.where(early | (F.col("dest_seq") >= success))
