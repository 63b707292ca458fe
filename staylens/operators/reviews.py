"""Guest reviews: parse, filter, cap, aggregate per traveller type, widen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staylens.functions import rules as R
from staylens.functions.markup import of_rule
from staylens.functions.stats import exact_sums, total
from staylens.functions.text import blank_to_null, field_name, mapped, part, safe_double, strip, year_of
from staylens.functions.workspace import stored
from staylens.operators.selection import with_elements
from staylens.schemas import count_column, mean_column

KEY = "property_id"


# --- cards -------------------------------------------------------------------


def cards_from_pages(review_pages: DataFrame) -> DataFrame:
    """Stored review pages ``(property_id, list_kind, page_no, html)`` -> review cards."""
    rules = (R.REVIEW_CARD_RULE, *R.CARD_RULES)
    kept = [f"`{c}`" for c in review_pages.columns if c != "html"]
    read = with_elements(review_pages, rules, scope=R.REVIEW_CARD_RULE.css)
    e = F.col("elements")

    def inside(card: Column, rule: str) -> Column:
        own = F.filter(of_rule(e, rule), lambda x: x["scope"] == card["scope"])
        return F.get(own, F.lit(0))["text"]

    cards = F.transform(
        of_rule(e, R.REVIEW_CARD_RULE.name),
        lambda c: F.struct(
            c["scope"].alias("pos"),
            inside(c, "card_score").alias("score_text"),
            inside(c, "card_stay_date").alias("stay_date"),
            inside(c, "card_traveler_type").alias("traveler_type"),
        ),
    )
    return read.select(*kept, F.inline(cards))


def parse_score(score_text: Column) -> Column:
    """Number after the first marker, NULL when unreadable."""
    return safe_double(part(score_text, R.SCORE_MARKER, 1))


def known_or_unknown(text: Column) -> Column:
    return F.coalesce(blank_to_null(strip(text)), F.lit(R.UNKNOWN))


def parse_cards(cards: DataFrame) -> DataFrame:
    """Typed cards: ``score``, ``stay_date``, ``stay_year``, ``traveler_type``.

    Cards without a readable score are dropped before anything else.  Write the
    result partitioned by ``stay_year`` and the year filters prune files.
    """
    return cards.withColumns(
        {
            "score": parse_score(F.col("score_text")),
            "stay_date": known_or_unknown(F.col("stay_date")),
            "traveler_type": known_or_unknown(F.col("traveler_type")),
            "stay_year": year_of(F.col("stay_date")),
        }
    ).where(F.col("score").isNotNull())


# --- filters -----------------------------------------------------------------


def lenient_year(target: int | None) -> Column:
    """ALL list: the year must be the target, but an unknown date is kept."""
    if not target:
        return F.lit(True)
    return (F.col("stay_date") == R.UNKNOWN) | F.coalesce(F.col("stay_year") == target, F.lit(False))


def strict_year(target: int | None) -> Column:
    """Business list: the year must be the target; an unknown date is dropped."""
    return F.coalesce(F.col("stay_year") == target, F.lit(False)) if target else F.lit(True)


def is_all() -> Column:
    return F.col("list_kind") == R.ALL_LIST


def is_business() -> Column:
    return F.col("list_kind") == R.BUSINESS_LIST


def known_type() -> Column:
    """The ALL list needs a traveller type, the business list does not."""
    return is_business() | (F.col("traveler_type") != R.UNKNOWN)


def in_year(target: int | None) -> Column:
    return (is_all() & lenient_year(target)) | (is_business() & strict_year(target))


def offered_only(cards: DataFrame, offered: DataFrame) -> DataFrame:
    """Business cards of the properties that offer that list; all other cards.

    A semi join needs no distinct keys; left as they are, both sides are
    shuffled for the join alone and a hot property can be split.
    """
    lists = offered.where(is_business()).select(KEY)
    business = cards.where(is_business()).join(lists, KEY, "left_semi")
    return cards.where(~is_business()).unionByName(business)


# --- order and cap -------------------------------------------------------------


def newest_first(cards: DataFrame) -> DataFrame:
    return cards.orderBy(F.desc("review_ts"), "review_id")


def newest_k(
    cards: DataFrame, pages: int | None = None, page_size: int = R.REVIEW_PAGE_SIZE
) -> DataFrame:
    """Newest ``pages * page_size`` cards per property and list, with ``seq`` from 1; all cards if ``pages`` is 0 or None.

    For cards that carry no page number; with one, ``first_pages`` needs no
    shuffle.  A list is split into lanes, the cards of each lane are counted, and a
    card's place is the number of cards in lanes before plus its place in its own.
    All cards: lanes are ranges of the order itself, dealt by samples and stored, so that
    a list without dates, or of one day, is split like any other and no task holds it.
    With a limit: lanes are days; those beyond the last wanted card are not ranked, and of each
    day no task keeps more cards than the limit.  Cards without a property or list are in no list.
    """
    keys = (KEY, "list_kind")
    order = (F.desc("review_ts"), F.col("review_id"))
    if pages:
        laned = cards.withColumn("lane", F.coalesce(F.to_date("review_ts"), F.to_date(F.lit("0001-01-01"))))
        sequence = F.desc("lane")
    else:
        listed = cards.where(F.col(KEY).isNotNull() & F.col("list_kind").isNotNull())
        laned = stored(listed.repartitionByRange(*keys, *order).withColumn("lane", F.spark_partition_id()), "newest")
        sequence = F.col("lane")
    before = W.partitionBy(*keys).orderBy(sequence).rowsBetween(W.unboundedPreceding, -1)
    days = laned.groupBy(*keys, "lane").agg(F.count("*").alias("n"))
    days = days.select(*keys, "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("later"))
    inside = W.partitionBy(*keys, "lane").orderBy(*order)
    if pages:
        k = pages * page_size
        days = days.where(F.col("later") < k)
        ranked = laned.withColumn("inside", F.row_number().over(inside)).where(F.col("inside") <= k)
    else:
        ranked = laned.withColumn("inside", F.row_number().over(inside))
    placed = ranked.join(days, [*keys, "lane"]).withColumn("seq", (F.col("later") + F.col("inside")).cast("int"))
    placed = placed.where(F.col("seq") <= k) if pages else placed
    return placed.select(*cards.columns, "seq")


def numbered_pages(
    cards: DataFrame, pages: int | None = None, page_size: int = R.REVIEW_PAGE_SIZE
) -> DataFrame:
    """The newest cards (all by default) with the page number and position they have on the site."""
    place = F.col("seq") - 1
    return (
        newest_k(cards, pages, page_size)
        .withColumns(
            {
                "page_no": (F.floor(place / page_size) + 1).cast("int"),
                "pos": (place % page_size + 1).cast("int"),
            }
        )
        .drop("seq")
    )


def first_pages(cards: DataFrame, pages: int | None = None) -> DataFrame:
    """Cap by stored page number: a filter that reaches the scan.  0 or None: no cap."""
    return cards.where(F.col("page_no") <= pages) if pages else cards


def capped(cards: DataFrame, pages: int | None = None) -> DataFrame:
    """The cards that are looked at, all by default: by page number where there is one, else the newest."""
    if not pages:
        return cards
    return first_pages(cards, pages) if "page_no" in cards.columns else numbered_pages(cards, pages)


def card_order(cards: DataFrame) -> Column:
    """Order in which cards are met: the ALL list, then the business list.

    One BIGINT from page number and position where the cards have them (cheap
    to aggregate); else the newest-first order itself.
    """
    later = is_business()
    if "page_no" in cards.columns:
        place = F.shiftleft(F.col("page_no").cast("bigint"), 31).bitwiseOR(F.col("pos").cast("bigint"))
        return F.when(later, F.lit(1 << 62)).otherwise(F.lit(0)) + place
    return F.struct(later, -F.unix_micros(F.col("review_ts").cast("timestamp")), "review_id")


# --- aggregation -----------------------------------------------------------------


def union_business(cards: DataFrame) -> DataFrame:
    """Business-list cards under their own raw type, after the ALL list.

    Nothing is removed: a business review that is also in ALL counts twice.
    """
    business = cards.where(is_business()).withColumn("traveler_type", F.lit(R.BUSINESS_RAW_TYPE))
    return cards.where(is_all()).unionByName(business)


def business_relabelled(cards: DataFrame) -> DataFrame:
    """Same rows as ``union_business`` from a single pass over the cards."""
    raw = F.when(is_business(), F.lit(R.BUSINESS_RAW_TYPE)).otherwise(F.col("traveler_type"))
    return cards.where(is_all() | is_business()).withColumn("traveler_type", raw)


def normal_type(raw: Column, table: Mapping[str, str] = R.TRAVELER_TYPE_MAP) -> Column:
    return mapped(field_name(raw), table)


def type_stats(cards: DataFrame, order: Column | None = None) -> DataFrame:
    """Mean and count per property and raw type.

    ``sum_exact``/``sum_other`` let later steps add groups up without the rows.
    With ``order`` (see ``card_order``), ``first_seen`` tells when the type first
    occurred.
    """
    exact, other = exact_sums(F.col("score"))
    aggs = [exact.alias("sum_exact"), other.alias("sum_other"), F.count("score").alias("n")]
    if order is not None:
        aggs.append(F.min(order).alias("first_seen"))
    stats = cards.groupBy(KEY, "traveler_type").agg(*aggs)
    return stats.withColumn("avg_score", total(F.col("sum_exact"), F.col("sum_other")) / F.col("n"))


def all_stats(stats: DataFrame) -> DataFrame:
    """Mean and count per property over all raw types, overwritten ones included."""
    added = stats.groupBy(KEY).agg(
        F.sum("sum_exact").alias("sum_exact"), F.sum("sum_other").alias("sum_other"), F.sum("n").alias("n")
    )
    mean = total(F.col("sum_exact"), F.col("sum_other")) / F.col("n")
    return added.select(KEY, mean.alias(mean_column("all")), F.col("n").alias(count_column("all")))


def resolve_collisions(stats: DataFrame, merge: bool = False) -> DataFrame:
    """One row per property and normal type name.

    Raw types with the same normal name do not add up: the one seen first
    *later* replaces the other.  ``merge=True`` adds them up instead.
    """
    named = stats.withColumn("traveler_type", normal_type(F.col("traveler_type")))
    if merge:
        added = named.groupBy(KEY, "traveler_type").agg(
            F.sum("sum_exact").alias("sum_exact"), F.sum("sum_other").alias("sum_other"), F.sum("n").alias("n")
        )
        mean = total(F.col("sum_exact"), F.col("sum_other")) / F.col("n")
        return added.select(KEY, "traveler_type", mean.alias("avg_score"), "n")
    last = F.max_by(F.struct("avg_score", "n"), "first_seen").alias("last")
    return named.groupBy(KEY, "traveler_type").agg(last).select(KEY, "traveler_type", "last.*")


def widen(resolved: DataFrame, kinds: Sequence[str] = R.TRAVELER_TYPES) -> DataFrame:
    """Fixed pairs of mean and count columns, one row per property.

    The list of types is given, so no job is needed to find it.
    """
    columns = []
    for kind in kinds:
        chosen = F.col("traveler_type") == kind
        columns.append(F.max(F.when(chosen, F.col("avg_score"))).alias(mean_column(kind)))
        columns.append(F.max(F.when(chosen, F.col("n"))).alias(count_column(kind)))
    return resolved.groupBy(KEY).agg(*columns)


def widen_all(resolved: DataFrame, fixed: Sequence[str] = R.TRAVELER_TYPES) -> DataFrame:
    """Fixed pairs, then pairs for every other type in sorted order.

    Finding the extra types is one small aggregation of type names; their number
    is limited by ``spark.sql.pivotMaxValues``.
    """
    wide = resolved.groupBy(KEY).pivot("traveler_type").agg(
        F.max("avg_score").alias("avg"), F.max("n").alias("n")
    )
    present = {c[: -len("_avg")] for c in wide.columns if c.endswith("_avg")}
    extra = sorted(present - set(fixed))
    columns = []
    for kind in (*fixed, *extra):
        there = kind in present
        mean = F.col(f"`{kind}_avg`") if there else F.lit(None).cast("double")
        count = F.col(f"`{kind}_n`") if there else F.lit(None).cast("bigint")
        columns += [mean.alias(mean_column(kind)), count.alias(count_column(kind))]
    return wide.select(KEY, *columns)


def traveler_record(stats: DataFrame, kinds: Sequence[str] = R.TRAVELER_TYPES) -> DataFrame:
    """Grand total and fixed type pairs of each property in one aggregation.

    Same values as ``all_stats`` joined to ``widen(resolve_collisions(..))``,
    with one shuffle of the per-type rows instead of three.
    """
    named = stats.withColumn("kind", normal_type(F.col("traveler_type")))
    last = [
        F.max_by(F.struct("avg_score", "n"), F.when(F.col("kind") == k, F.col("first_seen"))).alias(k) for k in kinds
    ]
    merged = named.groupBy(KEY).agg(
        F.sum("sum_exact").alias("sum_exact"),
        F.sum("sum_other").alias("sum_other"),
        F.sum("n").alias("n"),
        *last,
    )
    columns = [
        (total(F.col("sum_exact"), F.col("sum_other")) / F.col("n")).alias(mean_column("all")),
        F.col("n").alias(count_column("all")),
    ]
    for k in kinds:
        columns.append(F.col(k)["avg_score"].alias(mean_column(k)))
        columns.append(F.col(k)["n"].alias(count_column(k)))
    return merged.select(KEY, *columns)


def grouped_totals(stats: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Mean and count for several groupings of the per-type rows at once, in one pass with exact sums.

    ``sets`` are grouping sets such as ``[["city", "zone"], ["city"], []]``; a column that a set
    does not group by is NULL, and ``level`` (the bits of absent columns) tells the sets apart.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    added = stats.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("sum_exact").alias("sum_exact"),
        F.sum("sum_other").alias("sum_other"),
        F.sum("n").alias("n"),
    )
    mean = total(F.col("sum_exact"), F.col("sum_other")) / F.col("n")
    return added.select(*columns, "level", mean.alias("avg_score"), "n")


def rolled_up(stats: DataFrame, *columns: str) -> DataFrame:
    """``grouped_totals`` for all columns, all but the last, and so on to the grand total."""
    return grouped_totals(stats, [columns[:k] for k in range(len(columns), -1, -1)])


def type_map(resolved: DataFrame) -> DataFrame:
    """``property_id`` and ``types``: MAP of type name -> STRUCT<avg_score, n>.

    Any number of type names, without a pivot or a look at the names; a property's map holds as many
    entries as it has types.
    """
    entry = F.struct("traveler_type", F.struct("avg_score", "n"))
    return resolved.groupBy(KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("types"))


def from_type_map(mapped_types: DataFrame, kinds: Sequence[str] = R.TRAVELER_TYPES) -> DataFrame:
    """Fixed pairs of columns out of ``type_map``, and the other types as a map: the wide form for an export."""
    columns = []
    for kind in kinds:
        held = F.try_element_at("types", F.lit(kind))
        columns += [held["avg_score"].alias(mean_column(kind)), held["n"].alias(count_column(kind))]
    others = F.map_filter("types", lambda k, _: ~k.isin(*kinds))
    return mapped_types.select(KEY, *columns, others.alias("other_types"))


def reviewed_properties(cards: DataFrame) -> DataFrame:
    """Properties that show any review card, before all filters: the review gate."""
    return cards.select(KEY).distinct()
