"""Registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.functions import rules as R
from staylens.functions import text as X
from staylens.functions.markup import select_elements
from staylens.functions.workspace import scratch_dir, stored
from staylens.operators import attributes as A
from staylens.operators import crawl, elements, errors, links, location, prices, record, requests, runs, seen
from staylens.operators import reviews as V
from staylens.operators.selection import with_elements
from staylens.plans import records
from staylens.plans.reviews import raw_type_stats, traveler_means, traveler_means_all_types
from staylens.sinks.exports import export_run, page_heads
from staylens.sources import adapters as D
from staylens.sources import tables
from staylens.sources.exports import read_runs
from staylens.streaming import incremental, means

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = "2025-09-10"
RUN_TS = "2025-09-10 15:31:07"
YEAR = 2025
BATCHES, RUNS = 4, 3
NEEDLE = "/e"
TAG_NEEDLES = ('data-testid="title-link"', 'href="/que', 'href="/the', 'href="/')
BLOCKED = ("hetion", "enest")
EMPTY = ("ouque", "sch")
PAGE_RULES = (
    R.Rule("nav_link", "nav li > a", "href"),
    R.Rule("heading", "article > h1"),
    R.Rule("ad", "div[class*='ad']"),
    R.Rule("absent", "h3[data-testid='title'] > a", "href"),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _t(spark: SparkSession, sf: str, *names: str) -> DataFrame | tuple[DataFrame, ...]:
    read = tuple(D.table(spark, sf, n) for n in names)
    return read[0] if len(read) == 1 else read


# --- sources and requests ---------------------------------------------------------


@query
def search_requests(spark, sf):
    places = _t(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("dest_seq"), F.col("c_name").alias("city"))
    return requests.search_requests(places, RUN_DATE)


@query
def page_scan(spark, sf):
    return tables.pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("n_chars"))


@query
def page_head(spark, sf):
    return page_heads(_t(spark, sf, "pages")).select("page_id", "head")


@query
def record_key(spark, sf):
    keyed = record.stamped(_t(spark, sf, "pages"), RUN_TS)
    return keyed.select(
        "page_id", "property_id", "property_url", record.timestamp_text(F.col("scrape_timestamp")).alias("scrape_timestamp")
    )


# --- link harvest ------------------------------------------------------------------


@query
def link_explode(spark, sf):
    return links.explode_anchors(_t(spark, sf, "pages").select("page_id", "html"))


@query
def page_elements(spark, sf):
    found = _t(spark, sf, "pages").select("page_id", F.inline(select_elements(F.col("html"), PAGE_RULES)))
    return found.select("page_id", F.col("rule").alias("selector"), "ordinal", "text", "attr")


@query
def selected_elements(spark, sf):
    """The same elements from stored rows of tags and texts, without a Python worker."""
    found = with_elements(_t(spark, sf, "pages").select("page_id", "html"), PAGE_RULES).select("page_id", F.inline("elements"))
    return found.select("page_id", F.col("rule").alias("selector"), "ordinal", "text", "attr")


@query
def link_fallback(spark, sf):
    chosen = links.first_tag_rule_hrefs(F.col("html"), TAG_NEEDLES)
    return _t(spark, sf, "pages").select("page_id", F.posexplode(chosen).alias("pos", "href"))


@query
def link_fallback_rows(spark, sf):
    rows = stored(selected_elements(spark, sf), "elements")
    rule = F.when(F.col("selector") == "absent", 1).when(F.col("selector") == "heading", 2).otherwise(3)
    low = F.when(F.col("page_id") % 2 == 0, rule).otherwise(4 - rule)
    kept = links.fallback_elements(rows.withColumn("rule_no", low), ["page_id"])
    return kept.select("page_id", "rule_no", "selector", "ordinal", "text")


@query
def link_filter(spark, sf):
    found = D.links(_t(spark, sf, "pages"))
    return found.where(links.is_listing(F.col("href"), NEEDLE))


@query
def canonical_url(spark, sf):
    return _t(spark, sf, "pages").select("page_id", links.canonical_url(F.col("url")).alias("canonical"))


@query
def first_seen_links(spark, sf):
    return links.first_seen(D.links(_t(spark, sf, "pages")))


@query
def discover_rules(spark, sf):
    """Which of the seven link rules wins on each view, and its links."""
    return elements.rule_links(D.search_pages(_t(spark, sf, "pages")), ["dest_seq", "scroll_no"])


@query
def discover_links(spark, sf):
    """Search views -> usable links of the winning rules -> first seen, in built-in Spark alone."""
    found = elements.rule_links(D.search_pages(_t(spark, sf, "pages")), ["dest_seq", "scroll_no"])
    return links.first_seen(found.where(links.is_listing(F.col("href"))).select("dest_seq", "scroll_no", F.col("pos").cast("int").alias("pos"), "href"))


@query
def first_n_links(spark, sf):
    return links.first_n(links.first_seen(D.links(_t(spark, sf, "pages"))), 200)


@query
def first_n_per_destination(spark, sf):
    return links.first_n_per_destination(links.first_seen(D.links(_t(spark, sf, "pages"))), 20)


@query
def page_state(spark, sf):
    state = crawl.page_state(F.col("text"), BLOCKED, EMPTY)
    return _t(spark, sf, "documents").select("doc_id", state.alias("state"))


@query
def page_state_counts(spark, sf):
    return crawl.state_counts(_t(spark, sf, "documents"), "text", blocked=BLOCKED, empty=EMPTY)


@query
def destination_coverage(spark, sf):
    nation, customer = _t(spark, sf, "nation", "customer")
    places = nation.select(F.col("n_nationkey").alias("dest_seq"), F.col("n_name").alias("city"))
    return crawl.destination_coverage(places, customer.select(F.col("c_nationkey").alias("dest_seq")))


@query
def visited_views(spark, sf):
    dest, scroll = F.floor(F.col("doc_id") / 12).cast("int"), (F.col("doc_id") % 12 + 1).cast("int")
    views = _t(spark, sf, "documents").select(
        dest.alias("dest_seq"),
        scroll.alias("scroll_no"),
        (F.col("lang") == "en").alias("matched"),
        crawl.page_state(F.col("text"), BLOCKED, EMPTY).alias("state"),
        F.when((F.col("lang") == "en") & (dest > 1), F.col("n_chars")).otherwise(0).alias("n_links"),
    )
    return crawl.visited_views(views, max_views=10, patience=3)


# --- attributes -----------------------------------------------------------------------


@query
def price_digits(spark, sf):
    return _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", D.price_text().alias("price_text")
    ).withColumn("price", prices.price(F.col("price_text")))


@query
def price_min_max(spark, sf):
    rows = _t(spark, sf, "lineitem").select(
        "l_orderkey", D.price_tier().alias("tier"), prices.price(D.price_text()).alias("amount")
    )
    return prices.price_range(rows, "l_orderkey")


@query
def currency_scan(spark, sf):
    n, doc = F.col("n_chars"), F.col("doc_id")
    page = F.concat("text", F.lit(" $"), n, F.lit(" € "), doc, F.lit(" £"), n * 1000, F.lit(",5"))
    found = _t(spark, sf, "documents").select("doc_id", prices.currency_amounts(page).alias("amounts"))
    return found.select(
        "doc_id",
        F.size("amounts").alias("n_amounts"),
        F.array_min("amounts").alias("min_amount"),
        F.array_max("amounts").alias("max_amount"),
    )


@query
def category_extract(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", A.category(D.category_text()).alias("category"))


@query
def category_normalize(spark, sf):
    raw = F.when(F.col("p_type") == "ECONOMY", "Guest House").when(F.col("p_type") == "SMALL", "Condo Hotel")
    kind = A.normal_category(F.coalesce(raw, F.col("p_type")))
    return _t(spark, sf, "part").select("p_partkey", kind.alias("category"))


@query
def coordinates(spark, sf):
    text = D.coordinate_text(F.col("s_acctbal"), F.col("s_suppkey").cast("double"), F.col("s_suppkey") % 5)
    point = _t(spark, sf, "supplier").select("s_suppkey", A.coordinates(text).alias("point"))
    latitude, longitude = A.guarded(F.col("point"))
    return point.select("s_suppkey", latitude.alias("latitude"), longitude.alias("longitude"))


@query
def wifi_speed(spark, sf):
    speed = F.concat("n_chars", F.lit(" Mbps "))
    found = F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit(" • "), speed)).when(F.col("doc_id") % 3 == 1, speed)
    return _t(spark, sf, "documents").select("doc_id", A.wifi_speed(found).alias("wifi_speed"))


@query
def score_cast(spark, sf):
    value, kind = F.col("value").cast("string"), F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.concat(F.lit(" \t "), value, F.lit(" \n")))
        .when(kind == 1, F.concat(value, F.lit("f")))
        .when(kind == 2, F.lit("n/a"))
        .when(kind == 3, F.lit("1_000"))
        .when(kind == 4, F.concat(F.lit("-"), value))
        .otherwise(value)
    )
    return _t(spark, sf, "events").select("event_id", A.score(text).alias("score"))


@query
def count_digits(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "no reviews yet").otherwise(
        F.concat(F.format_number("o_orderkey", 0), F.lit(" reviews"))
    )
    return _t(spark, sf, "orders").select("o_orderkey", A.review_count(text).alias("review_count"))


@query
def subscores(spark, sf):
    short = F.when(F.col("label") % 3 == 0, F.slice("embedding", 1, 6)).otherwise(F.col("embedding"))
    return _t(spark, sf, "embeddings").select("vec_id", *A.subscores(short.cast("array<double>")))


@query
def review_gate(spark, sf):
    orders, lineitem = _t(spark, sf, "orders", "lineitem")
    properties = orders.select(
        F.col("o_orderkey").alias("property_id"),
        F.col("o_totalprice").alias("general_review"),
        F.col("o_custkey").alias("general_review_count"),
    )
    carded = V.reviewed_properties(lineitem.select(F.col("l_orderkey").alias("property_id")))
    joined = properties.join(carded.withColumn("carded", F.lit(True)), "property_id", "left")
    gated = A.review_gate(joined, F.coalesce("carded", F.lit(False)), ("general_review", "general_review_count"))
    return gated.drop("carded")


@query
def html_attributes(spark, sf):
    snapshots = D.property_snapshots(*_t(spark, sf, "pages", "part", "orders", "lineitem", "embeddings"))
    return A.page_attributes(snapshots).drop("url", "readable")


@query
def selected_attributes(spark, sf):
    """The same attributes from stored rows of tags and texts, without a Python worker."""
    snapshots = D.property_snapshots(*_t(spark, sf, "pages", "part", "orders", "lineitem", "embeddings"))
    return A.page_attributes(snapshots, built_in=True).drop("url", "readable")


# --- location ------------------------------------------------------------------------------


@query
def geo_lookup_join(spark, sf):
    customer, nation, region = _t(spark, sf, "customer", "nation", "region")
    known = F.col("c_mktsegment") != "MACHINERY"
    properties = customer.select(
        F.col("c_custkey").alias("property_id"),
        F.when(known, F.col("c_nationkey").cast("double")).alias("latitude"),
        F.when(known, F.col("c_nationkey") + F.lit(0.5)).alias("longitude"),
    )
    places = location.locations(D.nation_geocodes(nation, region))
    return location.locate(properties, places, "property_id")


@query
def json_fields(spark, sf):
    whole = F.concat(F.lit('{"display_name":"User '), "user_id", F.lit('","address":'), "props", F.lit("}"))
    body = F.when(F.col("event_id") % 13 == 0, F.substring_index(whole, ",", 1)).otherwise(whole)
    parsed = _t(spark, sf, "events").select("event_id", location.parse_response(body).alias("r"))
    return parsed.select("event_id", F.col("r.display_name").alias("display_name"), F.col("r.address")["k"].alias("address_k"))


@query
def address_clean(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", location.clean_address(F.col("text")).alias("address"))


def _address_map():
    key, segment, name = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_name")
    near = F.when(key % 5 == 0, "日本").when(key % 5 == 1, "").when(key % 5 == 2, F.concat(segment, F.lit(" é, 2 ")))
    suburb = F.when(key % 3 == 0, name).when(key % 3 == 1, "é")
    town = F.when(key % 4 == 0, F.concat(F.lit(" Gueznaïa "), key.cast("string")))
    return F.create_map(
        F.lit("neighbourhood"), near, F.lit("suburb"), suburb, F.lit("town"), town,
        F.lit("city"), F.when(key % 7 == 0, "").when(key % 7 == 1, name), F.lit("village"), segment,
    )


@query
def zone_coalesce(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", location.pick_zone(_address_map()).alias("zone"))


@query
def city_coalesce(spark, sf):
    return _t(spark, sf, "customer").select("c_custkey", location.pick_city(_address_map()).alias("city"))


# --- scalar helpers ---------------------------------------------------------------------------


@query
def strip_text(spark, sf):
    padded = F.concat(F.lit(" \t 　"), "text", F.lit("\r\n  "))
    return _t(spark, sf, "documents").select("doc_id", X.strip(padded).alias("stripped"))


@query
def split_second(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", X.part(F.col("text"), " the ", 1).alias("piece"))


@query
def field_names(spark, sf):
    name = X.field_name(F.concat_ws("-", "p_name", "p_type"))
    return _t(spark, sf, "part").select("p_partkey", name.alias("field_name"))


@query
def stamp_formats(spark, sf):
    ts = F.col("ts")
    return _t(spark, sf, "events").select(
        "event_id",
        F.date_format(ts, R.DATE_FORMAT).alias("day"),
        record.timestamp_text(ts).alias("second"),
        F.date_format(ts, R.RUN_STAMP_FORMAT).alias("stamp"),
    )


@query
def year_extract(spark, sf):
    year, kind = F.year("o_orderdate").cast("string"), F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit("Stayed in May "), year))
        .when(kind == 1, F.concat(F.lit("May"), year))
        .when(kind == 2, F.concat(F.lit("(1999) "), year, F.lit("-2031")))
    )
    return _t(spark, sf, "orders").select("o_orderkey", X.year_of(text).alias("stay_year"))


# --- reviews --------------------------------------------------------------------------------------


def _cards(spark, sf):
    return D.review_cards(_t(spark, sf, "events"))


def _parsed(spark, sf):
    return V.parse_cards(_cards(spark, sf))


CARD = ("property_id", "list_kind", "review_id")


@query
def review_score_parse(spark, sf):
    return _parsed(spark, sf).select(*CARD, "score", "stay_date", "stay_year", "traveler_type")


@query
def year_filter_lenient(spark, sf):
    return _parsed(spark, sf).where(V.is_all() & V.lenient_year(YEAR)).select(*CARD, "score")


@query
def year_filter_strict(spark, sf):
    return _parsed(spark, sf).where(V.is_business() & V.strict_year(YEAR)).select(*CARD, "score")


@query
def known_types(spark, sf):
    return _parsed(spark, sf).where(V.known_type()).select(*CARD, "traveler_type")


@query
def business_offered(spark, sf):
    offered = _t(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("property_id"),
        F.when(F.col("c_acctbal") > 4000, R.BUSINESS_LIST).otherwise(R.ALL_LIST).alias("list_kind"),
    )
    return V.offered_only(_cards(spark, sf), offered).select(*CARD)


@query
def newest_first(spark, sf):
    return V.newest_first(_cards(spark, sf)).select(*CARD, "review_ts")


@query
def newest_k_reviews(spark, sf):
    return V.newest_k(_cards(spark, sf), pages=2).select(*CARD, "seq")


@query
def first_review_pages(spark, sf):
    return V.first_pages(V.numbered_pages(_cards(spark, sf)), 2).select(*CARD, "page_no", "pos")


def _stats(spark, sf):
    return raw_type_stats(_cards(spark, sf), YEAR)


@query
def type_stats(spark, sf):
    kept = _parsed(spark, sf).where(V.in_year(YEAR)).where(V.known_type())
    return V.type_stats(kept).select("property_id", "traveler_type", "avg_score", "n")


@query
def union_business(spark, sf):
    kept = _parsed(spark, sf).where(V.in_year(YEAR)).where(V.known_type())
    return V.type_stats(V.union_business(kept)).select("property_id", "traveler_type", "avg_score", "n")


@query
def type_normalize(spark, sf):
    return _parsed(spark, sf).select(*CARD, "traveler_type", V.normal_type(F.col("traveler_type")).alias("kind"))


@query
def type_collision_last(spark, sf):
    return V.resolve_collisions(_stats(spark, sf))


@query
def type_collision_merged(spark, sf):
    return V.resolve_collisions(_stats(spark, sf), merge=True)


@query
def all_stats(spark, sf):
    return V.all_stats(_stats(spark, sf))


@query
def traveler_pivot(spark, sf):
    return V.widen(V.resolve_collisions(_stats(spark, sf)))


@query
def totals_rollup(spark, sf):
    return V.rolled_up(_stats(spark, sf), "property_id", "traveler_type")


@query
def totals_by_place(spark, sf):
    """Means by nation and segment, by nation, and over all, of the reviews of customers."""
    places = _t(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("property_id"), F.col("c_nationkey").alias("city"), F.col("c_mktsegment").alias("zone")
    )
    return V.grouped_totals(_stats(spark, sf).join(places, "property_id"), [["city", "zone"], ["city"], []])


@query
def traveler_type_map(spark, sf):
    wide = V.from_type_map(V.type_map(V.resolve_collisions(_stats(spark, sf))))
    other = F.try_element_at("other_types", F.lit("digital_nomad"))
    return wide.withColumns({"n_other": F.size("other_types"), "nomads": other["n"]}).drop("other_types")


@query
def dynamic_columns(spark, sf):
    return V.widen_all(V.resolve_collisions(stored(_stats(spark, sf), "type-stats")))


@query
def traveler_means_by_property(spark, sf):
    return traveler_means(_cards(spark, sf), YEAR)


@query
def traveler_means_dynamic(spark, sf):
    return traveler_means_all_types(_cards(spark, sf), YEAR)


@query
def html_review_cards(spark, sf):
    return V.cards_from_pages(D.review_pages(V.numbered_pages(_cards(spark, sf))))


# --- records ----------------------------------------------------------------------------------------


def _customer_base(spark, sf):
    customer, orders, part, embeddings = _t(spark, sf, "customer", "orders", "part", "embeddings")
    pages = record.stamped(D.customer_pages(customer), RUN_TS)
    found = A.element_attributes(D.customer_elements(customer, orders, part, embeddings))
    return pages.join(found, "page_id", "left").drop("url")


def _geocodes(spark, sf):
    return D.nation_geocodes(*_t(spark, sf, "nation", "region"))


def _record_cards(spark, sf):
    # the property key of a record is a hash of its URL, so cards carry it too
    url = F.concat(F.lit("https://stays.example/hotel/"), "property_id", F.lit(".html"))
    return _cards(spark, sf).withColumn("property_id", record.stable_id(url))


def _text_time(df):
    return df.withColumn("scrape_timestamp", record.timestamp_text(F.col("scrape_timestamp")))


@query
def property_record(spark, sf):
    rows = records.review_records(_customer_base(spark, sf), _geocodes(spark, sf), _record_cards(spark, sf), YEAR)
    return _text_time(rows)


@query
def record_15(spark, sf):
    return _text_time(records.short_records(_customer_base(spark, sf), _geocodes(spark, sf)))


@query
def record_31(spark, sf):
    """The review form over reviews of all years."""
    rows = records.review_records(_customer_base(spark, sf), _geocodes(spark, sf), _record_cards(spark, sf))
    return _text_time(rows)


@query
def export_defaults(spark, sf):
    return record.export_defaults(records.short_records(_customer_base(spark, sf), _geocodes(spark, sf)))


@query
def import_nulls(spark, sf):
    return _text_time(record.restore_nulls(export_defaults(spark, sf), schemas.RECORD_15))


@query
def run_id(spark, sf):
    orders, lineitem = _t(spark, sf, "orders", "lineitem")
    stops = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey",
        F.col("l_linenumber").alias("dest_seq"),
        F.concat(F.lit("City "), F.col("l_suppkey")).alias("city"),
        F.col("o_orderdate").alias("started"),
    )
    return runs.run_names(stops, ["o_orderkey"])


@query
def run_keys(spark, sf):
    orders, lineitem = _t(spark, sf, "orders", "lineitem")
    stops = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey",
        F.col("l_linenumber").alias("dest_seq"),
        F.concat(F.lit("City "), F.col("l_suppkey")).alias("city"),
        F.col("o_orderdate").alias("started"),
    )
    return runs.run_keys(stops, ["o_orderkey"])


@query
def run_summary(spark, sf):
    return runs.run_summary(_t(spark, sf, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F")


@query
def csv_runs(spark, sf):
    """Two runs with different extra columns, exported and read back together."""
    out = f"{scratch_dir(spark, 'csv')}/runs"
    rows = stored(records.review_records(_customer_base(spark, sf), _geocodes(spark, sf), _record_cards(spark, sf), YEAR), "records")
    for run, kind in enumerate(("students", "pilgrims")):
        extra = {schemas.mean_column(kind): F.col("general_review"), schemas.count_column(kind): F.col("general_review_count")}
        even = F.substring("property_id", 1, 1).isin(*"02468ace")
        export_run(rows.where(~even if run else even).withColumns(extra), out, f"r{run}")
    return _text_time(read_runs(spark, out, schemas.RECORD_31))


@query
def card_channel(spark, sf):
    """Every card, parsed or with the reason why not."""
    fields = {
        "score": errors.Reading(F.col("score_text"), V.parse_score(F.col("score_text")), required=True),
        "kind": errors.Reading(F.col("traveler_type"), V.normal_type(F.col("traveler_type")), required=True),
        "stay_year": errors.Reading(F.col("stay_date"), X.year_of(F.col("stay_date"))),
    }
    return errors.channel(_cards(spark, sf), CARD, fields)


@query
def file_channel(spark, sf):
    """CSV lines, some of which do not fit the schema."""
    out, key = f"{scratch_dir(spark, 'lines')}/events", F.col("event_id")
    line = (
        F.when(key % 10 == 3, F.concat(F.lit("x"), key, F.lit(",oops")))
        .when(key % 10 == 7, F.concat(key, F.lit(",n/a")))
        .otherwise(F.concat(key, F.lit(","), F.col("value").cast("string")))
    )
    _t(spark, sf, "events").select(line.alias("line")).write.text(out)
    kind = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return errors.csv_channel(spark, out, kind).drop("file")


@query
def error_rows(spark, sf):
    return runs.rejected(_customer_base(spark, sf), ("category", "latitude", "min_price"), ("page_id",))


# --- incremental ----------------------------------------------------------------------------------------


def _in_parts(rows, key, out, run):
    """Rows arrive in four parts, one after the other; all tasks write a part, and ``run`` takes it as one batch."""
    for part in range(BATCHES):
        rows.where(F.col(key) % BATCHES == part).write.parquet(f"{out}/arrivals/part={part}")
        run().awaitTermination()


@query
def stream_first_seen(spark, sf):
    """Pages arrive in four parts, one after the other, each a batch of its own."""
    out = scratch_dir(spark, "first-seen")

    def run():
        arriving = D.links(tables.stream(spark, f"{out}/arrivals/*", schemas.PAGES))
        return incremental.write_batches(
            incremental.first_seen_stream(arriving), f"{out}/rows", f"{out}/checkpoint", mode="update"
        )

    _in_parts(_t(spark, sf, "pages"), "page_id", out, run)
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


@query
def batch_metrics(spark, sf):
    """Orders arrive in four parts; done and total are counted while each batch is written."""
    out = scratch_dir(spark, "metrics")
    orders = _t(spark, sf, "orders")

    def run():
        arriving = tables.stream(spark, f"{out}/arrivals/*", orders.schema)
        return incremental.metered_batches(arriving, f"{out}/rows", f"{out}/metrics", f"{out}/checkpoint", F.col("o_orderstatus") == "F")

    _in_parts(orders, "o_orderkey", out, run)
    return spark.read.parquet(f"{out}/metrics")


@query
def first_n_split(spark, sf):
    return links.first_n_split(D.links(_t(spark, sf, "pages")), 1000)


@query
def seen_across_runs(spark, sf):
    """Three runs, each with a third of the pages; a run keeps the links that no earlier run has seen."""
    store, pages = scratch_dir(spark, "seen"), _t(spark, sf, "pages")
    found = [seen.add_run(store, D.links(pages.where(F.col("page_id") % RUNS == run)), run) for run in range(RUNS)]
    told = [new.withColumn("run", F.lit(run)) for run, new in enumerate(found)]
    return reduce(DataFrame.unionByName, told)


@query
def traveler_means_incremental(spark, sf):
    """Events arrive in four parts; partial sums of each are merged, the first two into a base."""
    out = scratch_dir(spark, "means")
    events = _t(spark, sf, "events")

    def run():
        arriving = D.review_cards(tables.stream(spark, f"{out}/arrivals/*", events.schema))
        return means.means_stream(arriving, f"{out}/state", f"{out}/checkpoint", YEAR, compact_every=2)

    _in_parts(events, "event_id", out, run)
    return V.traveler_record(means.state(spark, f"{out}/state"))


@query
def stream_records(spark, sf):
    """Property pages arrive in four parts; the records of each are flushed before the next is read."""
    out = scratch_dir(spark, "records")
    pages = stored(D.property_snapshots(*_t(spark, sf, "pages", "part", "orders", "lineitem", "embeddings")), "snapshots")

    def run():
        return incremental.run_incremental(
            tables.stream(spark, f"{out}/arrivals/*", pages.schema),
            lambda batch: A.page_attributes(batch, built_in=True),
            f"{out}/rows",
            f"{out}/checkpoint",
            per_batch=True,
        )

    _in_parts(pages, "page_id", out, run)
    return spark.read.parquet(f"{out}/rows").drop("batch_id", "url", "readable")
