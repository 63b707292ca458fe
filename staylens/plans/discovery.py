"""Search views -> listing links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.markup import of_rule, select_elements
from staylens.functions.rules import LINK_NEEDLE, LINK_RULES, Rule
from staylens.functions.workspace import stored
from staylens.operators.crawl import page_state, visited_views
from staylens.operators.links import absolute_url, first_n, first_rule_hrefs, first_seen, is_listing

# what a reader sees of the body: no head, no script, no markup
# (a tag that never ends runs to the end of the page, so that no later "<" is tried)
_UNSEEN = r"(?is)<(head|script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*+(?:>|$)"
_SPACES = r"(?i)(?:&nbsp;|&#160;|&#xa0;|[\s\u00A0]++)++"


def body_text(html: Column) -> Column:
    """Text of the page's body, white space and its entities as one space."""
    return F.regexp_replace(F.regexp_replace(html, _UNSEEN, " "), _SPACES, " ")


def read_views(views: DataFrame, rules: Sequence[Rule] = LINK_RULES, needle: str = LINK_NEEDLE) -> DataFrame:
    """One row per view: ``matched``, ``state`` and the usable ``hrefs``, page text dropped."""
    read = views.select(
        "dest_seq",
        "scroll_no",
        page_state(body_text(F.col("html"))).alias("state"),
        select_elements(F.col("html"), rules).alias("elements"),
    )
    hits = [F.transform(of_rule(F.col("elements"), r.name), lambda e: e["attr"]) for r in rules]
    chosen = F.transform(first_rule_hrefs(hits), lambda h: F.when(is_listing(h, needle), h))
    return read.select(
        "dest_seq",
        "scroll_no",
        "state",
        (F.size("elements") > 0).alias("matched"),
        chosen.alias("hrefs"),
    ).withColumn("n_links", F.size(F.array_compact("hrefs")))


def discover(
    views: DataFrame,
    limit: int | None = None,
    rules: Sequence[Rule] = LINK_RULES,
    needle: str = LINK_NEEDLE,
    max_views: int | None = None,
    patience: int | None = None,
    base: str | None = None,
) -> DataFrame:
    """Stored search views -> the first ``limit`` distinct listings, all by default.

    ``base`` is the address of the search pages, against which relative links are
    resolved; stored pages are found by their full address.  The pages are read once; the links of each view are stored, and which views
    count is decided on those rows.
    """
    kept = visited_views(stored(read_views(views, rules, needle), "views"), max_views, patience)
    links = kept.select("dest_seq", "scroll_no", F.posexplode("hrefs").alias("pos", "href"))
    links = links.withColumn("href", absolute_url(F.col("href"), base))
    return first_n(first_seen(links.where(F.col("href").isNotNull())), limit)
