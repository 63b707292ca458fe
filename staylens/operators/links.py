"""Link harvest: explode, rule fallback, filter, first-seen, first-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staylens.functions.markup import anchor_hrefs, anchor_tags, of_rule, select_elements, tag_href
from staylens.functions.rules import LINK_NEEDLE, LINK_RULES, Rule
from staylens.functions.text import before_first
from staylens.functions.workspace import stored

SEEN_ORDER = ("dest_seq", "scroll_no", "pos")


def canonical_url(href: Column) -> Column:
    """Text before the first ``?``; fragment, case and slashes stay."""
    return before_first(href, "?")


def absolute_url(href: Column, base: str | None) -> Column:
    """``href`` as a browser gives it on a page at ``base``; unchanged without a base.

    Full addresses stay, ``//host/..`` takes the scheme, ``/..`` the host, anything else
    the folder of the base.  Dot segments are left as they are.
    """
    if not base:
        return href
    scheme, _, rest = base.partition("://")
    host = rest.partition("/")[0].partition("?")[0].partition("#")[0]
    folder = rest.partition("?")[0].partition("#")[0]
    folder = folder.rpartition("/")[0] if "/" in folder else host
    return (
        F.when(F.regexp_like(href, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), href)
        .when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href))
        .when(href.startswith("/"), F.concat(F.lit(f"{scheme}://{host}"), href))
        .otherwise(F.concat(F.lit(f"{scheme}://{folder}/"), href))
    )


def is_listing(href: Column, needle: str = LINK_NEEDLE) -> Column:
    return href.isNotNull() & href.contains(needle)


def explode_anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """All anchors with an ``href`` of each page, ``pos`` from 0 in document order."""
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.posexplode(anchor_hrefs(F.col(html))).alias("pos", "href"))


def first_rule_hrefs(candidates: Sequence[Column]) -> Column:
    """The first non-empty array of hrefs; an empty array when none matches.

    A rule that matches only unusable links still wins, so that its links are
    filtered later and no lower rule is tried.
    """
    found = [F.when(F.size(c) > 0, c) for c in candidates]
    return F.coalesce(*found, F.array().cast("array<string>"))


def tag_rule_hrefs(html: Column, needles: Sequence[str]) -> list[Column]:
    """For rules that look at the anchor tag alone: per needle, the hrefs of the
    tags that contain it.  Stays in the JVM."""
    tags = anchor_tags(html)

    def hrefs(needle: str) -> Column:
        chosen = F.filter(tags, lambda t: t.contains(needle))
        return F.transform(chosen, tag_href)

    return [hrefs(n) for n in needles]


def first_tag_rule_hrefs(html: Column, needles: Sequence[str]) -> Column:
    """The hrefs of the first needle that any anchor tag contains; an empty array when none does.

    The tags of a page are found once, and only those of the winning needle are read for their link.
    """

    def with_needle(tags: Column, needle: str) -> Column:
        def holds(tag: Column) -> Column:
            return tag.contains(needle)

        return F.when(F.exists(tags, holds), F.filter(tags, holds))

    def choose(tags: Column) -> Column:
        won = F.coalesce(*(with_needle(tags, n) for n in needles), F.array().cast("array<string>"))
        return F.transform(won, tag_href)

    return F.get(F.transform(F.array(anchor_tags(html)), choose), F.lit(0))


def harvest_links(
    views: DataFrame, rules: Sequence[Rule] = LINK_RULES, html: str = "html"
) -> DataFrame:
    """Page views -> ``links(.., pos, href)`` of the winning rule of each view.

    Rules may look at enclosing elements, so the elements come from the markup
    step; choosing the rule is an array expression on the same row, no shuffle.
    """
    kept = [c for c in views.columns if c != html]
    elements = views.select(*kept, select_elements(F.col(html), rules).alias("elements"))
    hits = [F.transform(of_rule(F.col("elements"), r.name), lambda e: e["attr"]) for r in rules]
    return elements.select(*kept, F.posexplode(first_rule_hrefs(hits)).alias("pos", "href"))


def matched_any(views: DataFrame, rules: Sequence[Rule] = LINK_RULES, html: str = "html") -> DataFrame:
    """Page views with ``matched``: did any rule find an element?"""
    return views.withColumn("matched", F.size(select_elements(F.col(html), rules)) > 0)


def fallback_elements(elements: DataFrame, view: Sequence[str], rule: str = "rule_no") -> DataFrame:
    """Same choice on a table of element rows: keep all rows of the lowest rule per view.

    The lowest rule is an aggregate with map-side combine joined back, so that
    a view with very many elements is never sorted in one task.  ``elements`` is
    read twice: give it a stored table, not the markup step itself.
    """
    best = elements.groupBy(*view).agg(F.min(rule).alias(rule))
    return elements.join(best, [*view, rule], "left_semi")


def first_seen(links: DataFrame, order: Sequence[str] = SEEN_ORDER, href: str = "href") -> DataFrame:
    """One row per canonical URL: the first full href in ``order``.

    A minimum over a struct combines before the shuffle, so a URL that makes up
    a third of all rows arrives as one row per task.
    """
    rest = [c for c in links.columns if c not in order and c != href]
    first = F.min(F.struct(*order, href, *rest)).alias("first")
    keyed = links.withColumn("canonical", canonical_url(F.col(href)))
    return keyed.groupBy("canonical").agg(first).select("canonical", "first.*")


def first_n(links: DataFrame, limit: int | None = None, order: Sequence[str] = SEEN_ORDER) -> DataFrame:
    """The first ``limit`` links over all destinations; 0 or None means all.

    Early destinations can use up the limit; ``first_n_per_destination`` is the
    even-handed form.
    """
    return links.orderBy(*order).limit(limit) if limit else links


def first_n_split(links: DataFrame, limit: int, order: Sequence[str] = SEEN_ORDER) -> DataFrame:
    """``first_n`` for limits that no task can hold, in no particular order of rows.

    Rows are dealt to ranges of the order and stored; ranges are counted, and those that the
    limit covers are taken whole.  Only the one in which it falls is sorted for its first rows.
    """
    lane = F.spark_partition_id()
    laned = stored(links.repartitionByRange(*order).withColumn("lane", lane), "ranges")
    counts = laned.groupBy("lane").agg(F.count("*").alias("n")).orderBy("lane").collect()  # one row per range
    taken, whole, cut, rest = 0, -1, None, 0
    for row in counts:
        if taken + row["n"] > limit:
            cut, rest = row["lane"], limit - taken
            break
        taken, whole = taken + row["n"], row["lane"]
    kept = laned.where(F.col("lane") <= whole)
    if cut is not None and rest:
        rank = F.row_number().over(W.partitionBy("lane").orderBy(*order))
        kept = kept.unionByName(laned.where(F.col("lane") == cut).withColumn("rn", rank).where(F.col("rn") <= rest).drop("rn"))
    return kept.drop("lane")


def first_n_per_destination(links: DataFrame, limit: int, lanes: int = 64) -> DataFrame:
    """The first ``limit`` links of each destination.

    A destination is ranked in lanes first, so that at most ``lanes * limit`` of
    its links meet in one task, whatever the limit.
    """
    order = ("scroll_no", "pos")
    lane = W.partitionBy("dest_seq", "lane").orderBy(*order)
    whole = W.partitionBy("dest_seq").orderBy(*order)
    cut = links.withColumn("lane", F.pmod(F.xxhash64("href"), F.lit(lanes)))
    cut = cut.withColumn("rn", F.row_number().over(lane)).where(F.col("rn") <= limit).drop("lane")
    return cut.withColumn("rn", F.row_number().over(whole)).where(F.col("rn") <= limit).drop("rn")
