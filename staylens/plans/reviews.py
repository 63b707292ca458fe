"""Review cards -> means per traveller type, one row per property."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import stored
from staylens.operators import reviews as V


def kept_cards(
    cards: DataFrame,
    target_year: int | None = None,
    page_limit: int | None = None,
    offered: DataFrame | None = None,
) -> DataFrame:
    """Cards that enter the means: capped first if ``page_limit`` is given, then parsed and filtered."""
    if offered is not None:
        cards = V.offered_only(cards, offered)
    parsed = V.parse_cards(V.capped(cards, page_limit))
    return parsed.where(V.in_year(target_year)).where(V.known_type())


def raw_type_stats(
    cards: DataFrame,
    target_year: int | None = None,
    page_limit: int | None = None,
    offered: DataFrame | None = None,
) -> DataFrame:
    """Means, counts and first sighting per property and raw type of the kept cards."""
    kept = kept_cards(cards, target_year, page_limit, offered)
    return V.type_stats(V.business_relabelled(kept), V.card_order(kept))


def traveler_means(
    cards: DataFrame,
    target_year: int | None = None,
    page_limit: int | None = None,
    offered: DataFrame | None = None,
) -> DataFrame:
    """The grand total and the fixed type pairs of every property with kept cards.

    Cards with page numbers are shuffled once, as one partial sum per task,
    property and type; the per-type rows once more by property.
    """
    return V.traveler_record(raw_type_stats(cards, target_year, page_limit, offered))


def traveler_means_all_types(
    cards: DataFrame,
    target_year: int | None = None,
    page_limit: int | None = None,
    offered: DataFrame | None = None,
) -> DataFrame:
    """As ``traveler_means``, with a pair of columns for every further type.

    The per-type rows are stored, because the type names, the pairs and the
    total all come from them.
    """
    stats = stored(raw_type_stats(cards, target_year, page_limit, offered), "type-stats")
    # the grand total owns the name "all"
    wide = V.widen_all(V.resolve_collisions(stats).where(F.col("traveler_type") != "all"))
    return V.all_stats(stats).join(wide, V.KEY, "left")
