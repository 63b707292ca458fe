"""The given test tables in the shape of listing tables.

Used only by the registered queries and tests.  Each function keeps all rows of
its table; variants of texts follow from row numbers so that every branch of an
operator is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import rules as R
from staylens.operators.links import explode_anchors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _mod(column: str, n: int) -> Column:
    return F.col(column) % n


# --- events as review cards ---------------------------------------------------


def raw_type() -> Column:
    even = _mod("event_id", 2) == 0
    kind = F.col("event_type")
    return (
        F.when(kind == "view", F.when(even, "Couple").otherwise("Couples"))
        .when(kind == "click", F.when(even, "Family").otherwise("Families"))
        .when(kind == "signup", F.when(even, "Solo traveler").otherwise("Solo traveller"))
        .when(kind == "purchase", F.when(even, "Business traveler").otherwise("Digital-nomad"))
        .when(_mod("event_id", 3) == 0, "Group")
        .when(_mod("event_id", 3) == 1, "Group of friends")
    )


def review_cards(events: DataFrame) -> DataFrame:
    """One card per event in the ALL list, purchases in the business list as well."""
    marker = F.when(_mod("event_id", 11) == 0, "Rated ").otherwise(R.SCORE_MARKER)
    year = F.year("ts") + _mod("event_id", 3)
    stay = F.when(_mod("event_id", 7) == 1, " ").when(
        _mod("event_id", 7) > 1, F.concat(F.lit("Stayed in "), _text(year))
    )
    lists = F.when(
        F.col("event_type") == "purchase", F.array(F.lit(R.ALL_LIST), F.lit(R.BUSINESS_LIST))
    ).otherwise(F.array(F.lit(R.ALL_LIST)))
    return events.select(
        _text(F.col("user_id")).alias("property_id"),
        F.explode(lists).alias("list_kind"),
        F.col("ts").alias("review_ts"),
        F.col("event_id").alias("review_id"),
        F.concat(marker, _text(F.col("value"))).alias("score_text"),
        stay.alias("stay_date"),
        raw_type().alias("traveler_type"),
    )


# --- pages as search views ------------------------------------------------------


def view_order() -> tuple[Column, Column]:
    """Pages dealt to seven destinations in turn."""
    return _mod("page_id", 7).cast("int"), F.floor(F.col("page_id") / 7).cast("int")


def links(pages: DataFrame) -> DataFrame:
    """Anchors of all pages; the page number as a query makes full URLs differ."""
    dest, scroll = view_order()
    anchors = explode_anchors(pages.select("page_id", "html"))
    href = F.concat("href", F.lit("?p="), _text(F.col("page_id")))
    return anchors.select(dest.alias("dest_seq"), scroll.alias("scroll_no"), "pos", href.alias("href"))


def search_pages(pages: DataFrame) -> DataFrame:
    """Pages as search views with listing markup after their own: each of the seven link rules wins on some of them."""
    n, kind = _text(F.col("page_id") % 50), F.col("page_id") % 9

    def link(path: str, tail: str = "", attributes: str = "") -> Column:
        return F.concat(F.lit(f'<a {attributes}href="/hotel/{path}'), n, F.lit(f'{tail}">t</a>'))

    def within(start: str, inner: Column, end: str) -> Column:
        return F.concat(F.lit(start), inner, F.lit(end))

    title = '<h3 data-testid="title">'
    block = (
        F.when(kind == 0, F.concat(within(title, link("h"), "</h3>"), link("t", "?v=1", 'data-testid="title-link" ')))
        .when(kind == 1, F.concat(within(title, link("h", "?a"), "</h3>"), within(title + "<span>", link("no"), "</span></h3>")))
        .when(kind == 2, F.concat(within('<div data-testid="property-card"><p><b>', link("c", "?x=1&amp;y=2"), "</b></div>"), link("out")))
        .when(kind == 3, F.concat(link("e", "#f", 'class="k e13098a59f z" '), link("no")))
        .when(kind == 4, F.concat(link("p"), link("q", "#map"), link("h", "?b")))
        .when(kind == 5, within('<div class="x sr_property_block"><div>', link("s", "#a", 'class="hotel_name_link" '), "</div></div>"))
        .when(kind == 6, link("j", "#b", 'class="js-sr-hotel-link" '))
        .when(kind == 7, F.concat(F.lit('<a data-testid="title-link" href="/other/x">t</a>'), link("lost")))
        .otherwise(within("<!-- ", link("hidden", "", 'data-testid="title-link" '), " -->"))
    )
    dest, scroll = view_order()
    return pages.select(dest.alias("dest_seq"), scroll.alias("scroll_no"), F.concat("html", block).alias("html"))


# --- texts ------------------------------------------------------------------------


def price_text() -> Column:
    amount = F.col("l_extendedprice")
    return (
        F.when(F.col("l_linenumber") == 7, "Sold out")
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("€ "), _text(amount)))
        .otherwise(F.concat(F.lit("MAD "), F.format_number(F.floor(amount), 0)))
    )


def price_tier() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "A", 1).when(flag == "N", 2).otherwise(3)


def category_text() -> Column:
    size, name = _mod("p_size", 4), F.col("p_name")
    brand = F.concat(F.lit(" ("), "p_brand", F.lit(")"))
    kind = F.concat(F.lit(" ("), "p_type", F.lit(")"))
    return (
        F.when(size == 0, name)
        .when(size == 1, F.concat(name, kind))
        .when(size == 2, F.concat(name, brand, kind))
        .otherwise(F.concat(name, brand, F.lit(" (Guest House)"), kind))
    )


def coordinate_text(lat: Column, lon: Column, variant: Column) -> Column:
    def pair(a: str, b: str, x: Column, y: Column) -> Column:
        return F.concat(F.lit(f'"{a}":'), x, F.lit(f',"{b}":'), y)

    lat, lon = _text(lat), _text(lon)
    return (
        F.when(variant == 0, pair("latitude", "longitude", lat, lon))
        .when(
            variant == 1,
            F.concat(pair("latitude", "longitude", F.lit("1.2.3"), lon), F.lit(";"), pair("lat", "lng", lat, lon)),
        )
        .when(variant == 2, pair("latitude", "longitude", F.lit("0.0"), lon))
        .when(variant == 3, F.lit("no map"))
        .otherwise(pair("lat", "lng", lat, lon))
    )


def address_body(city: Column, suburb: Column, name: Column) -> Column:
    """Geocoder response text with a display name and an address map."""
    return F.concat(
        F.lit('{"display_name":"'), name, F.lit('","address":{"suburb":"'), suburb,
        F.lit('","city":"'), city, F.lit('"}}'),
    )


# --- customers as properties ----------------------------------------------------------


def customer_pages(customer: DataFrame) -> DataFrame:
    url = F.concat(
        F.lit("https://stays.example/hotel/"), _text(F.col("c_custkey")), F.lit(".html?seg="), "c_mktsegment"
    )
    return customer.select(F.col("c_custkey").alias("page_id"), url.alias("url"))


def customer_elements(
    customer: DataFrame, orders: DataFrame, part: DataFrame, embeddings: DataFrame
) -> DataFrame:
    """Element rows of one property page per customer."""

    def rows(df: DataFrame, key: str, selector: Column, ordinal: Column, text: Column) -> DataFrame:
        return df.select(
            F.col(key).cast("bigint").alias("page_id"),
            selector.alias("selector"),
            ordinal.cast("int").alias("ordinal"),
            text.alias("text"),
        )

    one = F.lit(1)
    status = F.col("o_orderstatus")
    tier = (
        F.when(status == "F", R.PRICE_PRIMARY_RULE.name)
        .when(status == "O", R.PRICE_GENERIC_RULES[1].name)
        .otherwise("price_scan")
    )
    prices = rows(
        orders, "o_custkey", tier, one,
        F.concat(F.lit("MAD "), F.format_number(F.floor("o_totalprice"), 0)),
    )
    categories = rows(part, "p_partkey", F.lit(R.CATEGORY_RULE.name), one, category_text())
    balance = rows(customer, "c_custkey", F.lit(R.SCORE_RULE.name), one, _text(F.col("c_acctbal")))
    counts = rows(
        customer, "c_custkey", F.lit(R.COUNT_RULE.name), one,
        F.concat(F.format_number("c_custkey", 0), F.lit(" reviews")),
    )
    point = coordinate_text(
        F.col("c_nationkey").cast("double"), F.col("c_nationkey") + F.lit(0.5), _mod("c_custkey", 5)
    )
    points = rows(customer, "c_custkey", F.lit("coordinates"), one, point)
    speed = F.concat(F.lit("Free • "), _text(F.col("c_nationkey")), F.lit(" Mbps"))
    wifi = rows(customer.where(F.col("c_mktsegment") == "BUILDING"), "c_custkey", F.lit(R.WIFI_RULE.name), one, speed)
    listed = embeddings.select("vec_id", F.posexplode("embedding").alias("at", "x"))
    whole = F.floor(F.col("x").cast("double") * 100)
    subs = rows(listed, "vec_id", F.lit(R.SUBSCORE_RULE.name), F.col("at") + 1, _text(whole))
    result = prices
    for more in (categories, balance, counts, points, wifi, subs):
        result = result.unionByName(more)
    return result


def nation_geocodes(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One good response per nation; nations of the first region are stored elsewhere.

    For some nations an empty or a broken response to the same request is stored too.
    """
    placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    lat = F.col("n_nationkey").cast("double") + F.when(F.col("n_regionkey") == 0, 1000.0).otherwise(0.0)
    body = address_body(
        F.col("r_name"), F.concat("n_name", F.lit(", Médina")), F.concat("n_name", F.lit(", Rue é 1, "), "r_name")
    )
    failed = F.when(F.col("n_nationkey") % 3 == 0, F.lit("")).when(F.col("n_nationkey") % 3 == 1, F.lit("!{"))
    bodies = F.array_compact(F.array(body, failed))
    return placed.select(lat.alias("lat"), (F.col("n_nationkey") + F.lit(0.5)).alias("lon"), F.explode(bodies).alias("body"))


# --- pages as property snapshots ---------------------------------------------------------


def property_snapshots(
    pages: DataFrame, part: DataFrame, orders: DataFrame, lineitem: DataFrame, embeddings: DataFrame
) -> DataFrame:
    """The given pages with property markup from the other tables after them.

    Works on a streaming ``pages`` too: the other tables are joined as they are.
    """

    def cell(text: Column) -> Column:
        markup = F.concat(
            F.lit('<td class="hprt-table-cell hprt-table-cell-price"><div class="hprt-price-block"><div class="prco-wrapper">'
                  '<span class="prco-valign-middle-helper bold">'),
            text,
            F.lit("</span></div></div></td>"),
        )
        return F.coalesce(markup, F.lit(""))

    # every line of an order is a cell, in the order of its lines
    lines = lineitem.select(F.col("l_orderkey").alias("page_id"), "l_linenumber", cell(price_text()).alias("cell"))
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "cell")))
    cells = lines.groupBy("page_id").agg(F.array_join(F.transform(ordered, lambda x: x["cell"]), "").alias("cells"))
    crumbs = part.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(
            F.lit('<span data-testid="breadcrumb-current"><span>'), category_text(), F.lit("</span></span>")
        ).alias("crumb"),
    )
    card = F.concat(
        F.lit('<div id="js--hp-gallery-scorecard"><a href="#tab-reviews"><div><div><div><div>Good</div><div> '),
        _text(F.col("o_totalprice")),
        F.lit(" </div><div>of</div><div><div>from</div><div>"),
        F.format_number("o_custkey", 0),
        F.lit(" reviews</div></div></div></div></div></a></div>"
              '<script>var map={"latitude":'),
        _text(F.col("o_totalprice")),
        F.lit(',"longitude":'),
        _text(F.col("o_custkey")),
        F.lit("}</script><div>Free • "),
        _text(F.col("o_custkey")),
        F.lit(" Mbps</div>"),
    )
    cards = orders.select(F.col("o_orderkey").alias("page_id"), card.alias("card"))
    sub = F.array_join(
        F.transform(
            F.col("embedding"),
            lambda x: F.concat(
                F.lit('<div data-testid="review-subscore"><div aria-hidden="true">'),
                _text(F.floor(x.cast("double") * 100)),
                F.lit("</div></div>"),
            ),
        ),
        "",
    )
    subs = embeddings.select(
        F.col("vec_id").alias("page_id"),
        F.concat(sub, F.lit('<div data-testid="review-card">x</div>')).alias("subs"),
    )
    joined = pages
    for extra in (cells, crumbs, cards, subs):
        joined = joined.join(extra, "page_id", "left")
    block = F.concat(
        F.coalesce("crumb", F.lit("")),
        F.lit("<table><tr>"),
        F.coalesce("cells", F.lit("")),
        F.lit("</tr></table>"),
        F.coalesce("card", F.lit("")),
        F.coalesce("subs", F.lit("")),
    )
    return joined.select("page_id", "url", F.concat("html", block).alias("html"))


def review_pages(cards: DataFrame) -> DataFrame:
    """Review pages with the markup of ten cards each, from cards with page numbers."""

    def tag(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f'<span data-testid="{name}">'), value, F.lit("</span>")), F.lit(""))

    card = F.concat(
        F.lit('<div data-testid="review-card"><div><div>'),
        "score_text",
        F.lit("</div></div>"),
        tag("review-stay-date", F.col("stay_date")),
        tag("review-traveler-type", F.col("traveler_type")),
        F.lit("</div>"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", card.alias("card"))))
    pages = cards.groupBy("property_id", "list_kind", "page_no").agg(ordered.alias("cards"))
    return pages.select(
        "property_id",
        "list_kind",
        "page_no",
        F.array_join(F.transform("cards", lambda c: c["card"]), "").alias("html"),
    )
