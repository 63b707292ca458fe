"""For each registered query the same result as SQL on the given tables."""

from __future__ import annotations

from staylens.schemas import BLANK_WHEN_MISSING, RECORD_31

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288)"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# --- events as review cards -----------------------------------------------------

_CARDS = """
base AS (
  SELECT CAST(user_id AS VARCHAR) AS property_id, ts AS review_ts, event_id AS review_id, event_type,
    CASE WHEN event_id % 11 = 0 THEN 'Rated ' ELSE 'Scored ' END || CAST(value AS VARCHAR) AS score_text,
    CASE WHEN event_id % 7 = 1 THEN ' '
         WHEN event_id % 7 > 1 THEN 'Stayed in ' || CAST(year(ts) + event_id % 3 AS VARCHAR) END AS stay_date,
    CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'Couple' ELSE 'Couples' END
         WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'Family' ELSE 'Families' END
         WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'Solo traveler' ELSE 'Solo traveller' END
         WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'Business traveler' ELSE 'Digital-nomad' END
         WHEN event_id % 3 = 0 THEN 'Group' WHEN event_id % 3 = 1 THEN 'Group of friends' END AS traveler_type
  FROM events),
cards AS (
  SELECT 'ALL' AS list_kind, * FROM base
  UNION ALL
  SELECT 'BUSINESS_TRAVELLERS' AS list_kind, * FROM base WHERE event_type = 'purchase'),
paged AS (
  SELECT *, row_number() OVER (PARTITION BY property_id, list_kind ORDER BY review_ts DESC, review_id) AS seq
  FROM cards)"""

# score > 0 has two decimals: cents are whole numbers, so sums are exact
_PARSED = """
parsed AS (
  SELECT property_id, list_kind, review_ts, review_id, seq,
    TRY_CAST(split_part(score_text, 'Scored ', 2) AS DOUBLE) AS score,
    coalesce(nullif(trim(stay_date), ''), 'Unknown') AS stay_date,
    TRY_CAST(nullif(regexp_extract(stay_date, '\\b(20[0-9]{2})\\b', 1), '') AS INTEGER) AS stay_year,
    coalesce(traveler_type, 'Unknown') AS traveler_type
  FROM paged WHERE contains(score_text, 'Scored '))"""

_KEPT = """
kept AS (
  SELECT * FROM parsed
  WHERE (list_kind = 'ALL' AND (stay_date = 'Unknown' OR stay_year = 2025) AND traveler_type <> 'Unknown')
     OR (list_kind = 'BUSINESS_TRAVELLERS' AND stay_year = 2025))"""

_KEPT_OF_ALL_YEARS = """
kept AS (SELECT * FROM parsed WHERE list_kind = 'BUSINESS_TRAVELLERS' OR traveler_type <> 'Unknown')"""

_MEAN = "CAST(sum(CAST(round(score * 100) AS BIGINT)) AS DOUBLE) / 100.0 / count(*)"
_MEAN_OF_CENTS = "CAST(sum(cents) AS DOUBLE) / 100.0 / sum(n)"

_STATS = """
relabelled AS (
  SELECT property_id, list_kind, seq, score,
    CASE WHEN list_kind = 'ALL' THEN traveler_type ELSE 'Business travellers' END AS traveler_type
  FROM kept),
stats AS (
  SELECT property_id, traveler_type, sum(CAST(round(score * 100) AS BIGINT)) AS cents, count(*) AS n,
    min(CASE WHEN list_kind = 'ALL' THEN 0 ELSE 1000000000 END + seq) AS first_seen
  FROM relabelled GROUP BY ALL)"""


def _kind(raw: str) -> str:
    return f"""CASE lower(replace(replace({raw}, ' ', '_'), '-', '_'))
      WHEN 'couple' THEN 'couples' WHEN 'group' THEN 'groups_friends'
      WHEN 'solo_traveler' THEN 'solo_travelers' WHEN 'solo_traveller' THEN 'solo_travelers'
      WHEN 'group_of_friends' THEN 'groups_friends' WHEN 'family' THEN 'families'
      WHEN 'business_traveller' THEN 'business_travellers' WHEN 'business_traveler' THEN 'business_travellers'
      ELSE lower(replace(replace({raw}, ' ', '_'), '-', '_')) END"""


_RESOLVED = f"""
named AS (SELECT property_id, {_kind('traveler_type')} AS kind, cents, n, first_seen FROM stats),
ranked AS (SELECT *, row_number() OVER (PARTITION BY property_id, kind ORDER BY first_seen DESC) AS r FROM named),
resolved AS (
  SELECT property_id, kind, CAST(cents AS DOUBLE) / 100.0 / n AS avg_score, n FROM ranked WHERE r = 1)"""

_KINDS = ("families", "couples", "solo_travelers", "business_travellers", "groups_friends")


def _pairs(kinds: tuple[str, ...]) -> str:
    return ", ".join(
        f"max(avg_score) FILTER (WHERE kind = '{k}') AS avg_review_score_{k}, "
        f"max(n) FILTER (WHERE kind = '{k}') AS avg_review_score_{k}_count"
        for k in kinds
    )


_TOTALS = f"""
totals AS (
  SELECT property_id, {_MEAN_OF_CENTS} AS avg_review_score_all, CAST(sum(n) AS BIGINT) AS avg_review_score_all_count
  FROM stats GROUP BY property_id)"""
_WIDE = f"wide AS (SELECT property_id, {_pairs(_KINDS)} FROM resolved GROUP BY property_id)"
_WIDE_EXTRA = f"wide AS (SELECT property_id, {_pairs((*_KINDS, 'digital_nomad'))} FROM resolved GROUP BY property_id)"

_TO_STATS = f"WITH {_CARDS}, {_PARSED}, {_KEPT}, {_STATS}"
_TO_RESOLVED = f"{_TO_STATS}, {_RESOLVED}"

# --- pages -------------------------------------------------------------------------

_ANCHORS = """
anchors AS (
  SELECT page_id, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a\\b[^>]*?\\bhref="([^"]*)"', 1) AS hrefs FROM pages))"""

_LINKS = f"""{_ANCHORS},
links AS (
  SELECT CAST(page_id % 7 AS INTEGER) AS dest_seq, CAST(page_id // 7 AS INTEGER) AS scroll_no,
    CAST(pos AS INTEGER) AS pos, href || '?p=' || CAST(page_id AS VARCHAR) AS href
  FROM anchors)"""

# what the adapter puts on a view, by page number: the rule that wins and its links
_RULED = """
n AS (SELECT page_id % 7 AS d, page_id // 7 AS s, page_id % 9 AS kind, CAST(page_id % 50 AS VARCHAR) AS n FROM pages),
ruled AS (
  SELECT CAST(d AS INTEGER) AS dest_seq, CAST(s AS INTEGER) AS scroll_no,
    CAST(CASE kind WHEN 7 THEN 1 ELSE kind + 1 END AS INTEGER) AS rule_no, CAST(pos AS INTEGER) AS pos, href
  FROM n, LATERAL (SELECT unnest(range(2)) AS pos, unnest(CASE kind
    WHEN 0 THEN ['/hotel/t' || n || '?v=1'] WHEN 1 THEN ['/hotel/h' || n || '?a'] WHEN 2 THEN ['/hotel/c' || n || '?x=1&y=2']
    WHEN 3 THEN ['/hotel/e' || n || '#f'] WHEN 4 THEN ['/hotel/p' || n, '/hotel/h' || n || '?b'] WHEN 5 THEN ['/hotel/s' || n || '#a']
    WHEN 6 THEN ['/hotel/j' || n || '#b'] WHEN 7 THEN ['/other/x'] ELSE [] END) AS href) WHERE href IS NOT NULL)"""

_FIRST_SEEN = f"""{_LINKS},
seen AS (
  SELECT split_part(href, '?', 1) AS canonical, dest_seq, scroll_no, pos, href,
    row_number() OVER (PARTITION BY split_part(href, '?', 1) ORDER BY dest_seq, scroll_no, pos) AS r
  FROM links),
first_seen AS (SELECT canonical, dest_seq, scroll_no, pos, href FROM seen WHERE r = 1)"""

_STATE = """CASE WHEN contains(lower(text), 'hetion') OR contains(lower(text), 'enest') THEN 'blocked'
  WHEN contains(lower(text), 'ouque') OR contains(lower(text), 'sch') THEN 'empty' ELSE 'ok' END"""


def _plain(markup: str) -> str:
    """Text content of simple markup; a name like ``&amp`` may lack its semicolon."""
    text = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
    for entity, sign in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "''"), ("&copy", "©"),
                         ("&middot", "·"), ("&nbsp", " "), ("&amp", "&")):
        text = f"regexp_replace({text}, '{entity};?', '{sign}', 'g')"
    return text


_ELEMENTS = f"""
nav AS (
  SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS found FROM pages),
elements AS (
  SELECT page_id, 'nav_link' AS selector, CAST(unnest(range(1, len(found) + 1)) AS INTEGER) AS ordinal,
    {_plain("unnest(found)")} AS text, regexp_extract(unnest(found), 'href="([^"]*)"', 1) AS attr FROM nav
  UNION ALL
  SELECT page_id, 'heading', 1, {_plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, NULL
  FROM pages WHERE regexp_matches(html, '<article><h1>')
  UNION ALL
  SELECT page_id, 'ad', 1, {_plain("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")}, NULL
  FROM pages WHERE contains(html, '<div class="ad">'))"""

# --- texts ----------------------------------------------------------------------------

_PRICE_TEXT = """CASE WHEN l_linenumber = 7 THEN 'Sold out'
  WHEN l_linenumber = 2 THEN '€ ' || CAST(l_extendedprice AS VARCHAR)
  ELSE 'MAD ' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) END"""


def _digits(text: str) -> str:
    return f"TRY_CAST(nullif(regexp_replace({text}, '[^0-9]', '', 'g'), '') AS BIGINT)"


_CATEGORY_TEXT = """CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' (' || p_type || ')'
  WHEN 2 THEN p_name || ' (' || p_brand || ') (' || p_type || ')'
  ELSE p_name || ' (' || p_brand || ') (Guest House) (' || p_type || ')' END"""


def _category(text: str) -> str:
    found = f"regexp_extract_all({text}, '\\(([^)]+)\\)', 1)"
    return f"CASE WHEN len({found}) >= 2 THEN {found}[-2] WHEN len({found}) = 1 THEN {found}[1] ELSE {text} END"


def _normal(name: str) -> str:
    return f"CASE {name} WHEN 'Guest House' THEN 'Riad' WHEN 'Condo Hotel' THEN 'Apartment-Hotel' ELSE {name} END"


def _latin(text: str) -> str:
    return f"regexp_replace({text}, '[^a-zA-Z0-9\\s\\-,.'']', '', 'g')"


# variants 0, 1 and 4 carry the point, 2 a zero, 3 nothing
def _point(value: str, lat: str, lon: str, variant: str) -> str:
    return f"CASE WHEN {variant} IN (0, 1, 4) AND {lat} <> 0 AND {lon} <> 0 THEN {value} END"


# --- customers as properties -------------------------------------------------------------

_BASE = f"""
order_prices AS (
  SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS tier,
    CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders),
lowest AS (SELECT o_custkey, min(tier) AS tier FROM order_prices GROUP BY ALL),
prices AS (
  SELECT o_custkey, min(amount) AS min_price, max(amount) AS max_price
  FROM order_prices JOIN lowest USING (o_custkey, tier) GROUP BY ALL),
kinds AS (SELECT p_partkey, {_CATEGORY_TEXT} AS t FROM part),
attributes AS (
  SELECT c_custkey AS page_id,
    sha256('https://stays.example/hotel/' || CAST(c_custkey AS VARCHAR) || '.html') AS property_id,
    'https://stays.example/hotel/' || CAST(c_custkey AS VARCHAR) || '.html?seg=' || c_mktsegment AS property_url,
    '2025-09-10 15:31:07' AS scrape_timestamp,
    {_normal("(" + _category("t") + ")")} AS category,
    c_acctbal AS general_review, c_custkey AS general_review_count,
    floor(CAST(embedding[4] AS DOUBLE) * 100) AS comfort_score, floor(CAST(embedding[5] AS DOUBLE) * 100) AS value_score,
    floor(CAST(embedding[6] AS DOUBLE) * 100) AS location_score, floor(CAST(embedding[7] AS DOUBLE) * 100) AS wifi_score,
    min_price, max_price,
    {_point("CAST(c_nationkey AS DOUBLE)", "c_nationkey", "1", "c_custkey % 5")} AS latitude,
    {_point("CAST(c_nationkey + 0.5 AS DOUBLE)", "c_nationkey", "1", "c_custkey % 5")} AS longitude,
    CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey AS VARCHAR) || ' Mbps' ELSE 'Not specified' END AS wifi_speed
  FROM customer LEFT JOIN kinds ON p_partkey = c_custkey LEFT JOIN embeddings ON vec_id = c_custkey
    LEFT JOIN prices ON o_custkey = c_custkey)"""


def _place_rows() -> str:
    shown = "n_name || ', Rue é 1, ' || r_name"
    return f"""
places AS (
  SELECT CAST(n_nationkey AS DOUBLE) + CASE WHEN n_regionkey = 0 THEN 1000 ELSE 0 END AS lat, n_nationkey + 0.5 AS lon,
    replace(trim({_latin(shown)}), ',', ' ') AS address,
    trim({_latin("n_name || ', Médina'")}) AS zone,
    r_name AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


_PLACES = _place_rows()

_SHORT = f"""
{_BASE}, {_PLACES},
short AS (
  SELECT a.*, address, zone, city FROM attributes a LEFT JOIN places ON latitude = lat AND longitude = lon)"""

_COLUMNS_15 = """property_id, scrape_timestamp, property_url, category, general_review, general_review_count, wifi_score,
  min_price, max_price, latitude, longitude, address, zone, city, wifi_speed"""

_REVIEW_COLUMNS = ", ".join(
    f"avg_review_score_{k}, avg_review_score_{k}_count" for k in ("all", *_KINDS)
)


def _gated(column: str) -> str:
    return f"CASE WHEN r.property_id IS NOT NULL THEN {column} END AS {column}"


_GATED = ", ".join(
    _gated(c)
    for c in ("general_review", "general_review_count", "comfort_score", "value_score", "location_score", "wifi_score")
)

# --- pages as property snapshots -------------------------------------------------------------

_HTML_ATTRIBUTES = f"""
WITH line_prices AS (
  SELECT l_orderkey, min({_digits(_PRICE_TEXT)}) AS min_price, max({_digits(_PRICE_TEXT)}) AS max_price
  FROM lineitem GROUP BY ALL),
kinds AS (SELECT p_partkey, {_CATEGORY_TEXT} AS t FROM part)
SELECT page_id, {_normal("(" + _category("t") + ")")} AS category,
  o_totalprice AS general_review, nullif(o_custkey, -1) AS general_review_count,
  floor(CAST(embedding[4] AS DOUBLE) * 100) AS comfort_score, floor(CAST(embedding[5] AS DOUBLE) * 100) AS value_score,
  floor(CAST(embedding[6] AS DOUBLE) * 100) AS location_score, floor(CAST(embedding[7] AS DOUBLE) * 100) AS wifi_score,
  min_price, max_price,
  CASE WHEN o_custkey <> 0 THEN o_totalprice END AS latitude,
  CASE WHEN o_custkey <> 0 THEN CAST(o_custkey AS DOUBLE) END AS longitude,
  CASE WHEN o_custkey IS NOT NULL THEN CAST(o_custkey AS VARCHAR) || ' Mbps' ELSE 'Not specified' END AS wifi_speed,
  o_orderkey IS NOT NULL AND vec_id IS NOT NULL AS has_reviews
FROM pages LEFT JOIN line_prices ON l_orderkey = page_id LEFT JOIN kinds ON p_partkey = page_id
  LEFT JOIN orders ON o_orderkey = page_id LEFT JOIN embeddings ON vec_id = page_id"""

_ADDRESS_MAP = """
map AS (
  SELECT c_custkey, c_mktsegment, c_name,
    CASE c_custkey % 5 WHEN 0 THEN '日本' WHEN 1 THEN '' WHEN 2 THEN c_mktsegment || ' é, 2 ' END AS neighbourhood,
    CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'é' END AS suburb,
    CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN c_name END AS city,
    CASE WHEN c_custkey % 4 = 0 THEN ' Gueznaïa ' || CAST(c_custkey AS VARCHAR) END AS town
  FROM customer)"""


def _fallback_tags() -> str:
    def hrefs(needle: str) -> str:
        return f"[x for x in tags if contains(x, '{needle}')]"

    choice = " ".join(
        f"WHEN len({hrefs(n)}) > 0 THEN {hrefs(n)}"
        for n in ('data-testid="title-link"', 'href="/que', 'href="/the', 'href="/')
    )
    return f"""
WITH tags AS (SELECT page_id, regexp_extract_all(html, '<a\\b[^>]*>') AS tags FROM pages),
chosen AS (SELECT page_id, CASE {choice} ELSE [] END AS tags FROM tags)
SELECT page_id, CAST(unnest(range(len(tags))) AS INTEGER) AS pos,
  regexp_extract(unnest(tags), '\\bhref="([^"]*)"', 1) AS href FROM chosen"""


_REVIEW_RECORD = f"""
{_TO_RESOLVED}, {_TOTALS}, {_WIDE}, {_SHORT},
reviewed AS (SELECT DISTINCT sha256('https://stays.example/hotel/' || property_id || '.html') AS property_id FROM cards),
means AS (
  SELECT * REPLACE (sha256('https://stays.example/hotel/' || property_id || '.html') AS property_id)
  FROM totals JOIN wide USING (property_id))
SELECT s.property_id, scrape_timestamp, 2025 AS filtered_year, property_url, category, {_GATED}, {_REVIEW_COLUMNS},
  min_price, max_price, latitude, longitude, address, zone, city, wifi_speed
FROM short s LEFT JOIN reviewed r ON r.property_id = s.property_id LEFT JOIN means m ON m.property_id = s.property_id"""


def _restored() -> str:
    """Columns of the review record as they come back from an export: blanks and zeros are NULL again."""
    shown = []
    for field in RECORD_31:
        kind = field.dataType.typeName()
        if kind == "string":
            shown.append(f"nullif({field.name}, '') AS {field.name}")
        elif kind == "timestamp" or field.name in BLANK_WHEN_MISSING:
            shown.append(field.name)
        else:
            shown.append(f"nullif({field.name}, 0) AS {field.name}")
    return ", ".join(shown)


_CSV_RUNS = f"""
WITH rec AS ({_REVIEW_RECORD}),
told AS (SELECT *, substr(property_id, 1, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') AS even FROM rec)
SELECT CASE WHEN even THEN 'r0' ELSE 'r1' END AS run, {_restored()},
  CASE WHEN NOT even THEN nullif(general_review, 0) END AS avg_review_score_pilgrims,
  CASE WHEN NOT even THEN nullif(general_review_count, 0) END AS avg_review_score_pilgrims_count,
  CASE WHEN even THEN nullif(general_review, 0) END AS avg_review_score_students,
  CASE WHEN even THEN nullif(general_review_count, 0) END AS avg_review_score_students_count
FROM told"""

ORACLES: dict[str, str] = {
    "search_requests": """
SELECT CAST(c_custkey AS INTEGER) AS dest_seq, c_name AS city, DATE '2025-09-10' AS checkin, DATE '2025-09-11' AS checkout,
  'https://listings.example/searchresults.html?ss=' || c_name ||
  '&checkin=2025-09-10&checkout=2025-09-11&group_adults=1&no_rooms=1&group_children=0' AS url
FROM customer""",
    "page_scan": "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages",
    "page_head": "SELECT page_id, substring(html, 1, 10000) AS head FROM pages",
    "record_key": """
SELECT page_id, sha256(split_part(url, '?', 1)) AS property_id, url AS property_url,
  strftime(TIMESTAMP '2025-09-10 15:31:07', '%Y-%m-%d %H:%M:%S') AS scrape_timestamp FROM pages""",
    "link_explode": f"WITH {_ANCHORS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM anchors",
    "page_elements": f"WITH {_ELEMENTS} SELECT page_id, selector, ordinal, text, attr FROM elements",
    "selected_elements": f"WITH {_ELEMENTS} SELECT page_id, selector, ordinal, text, attr FROM elements",
    "link_fallback": _fallback_tags(),
    "link_fallback_rows": f"""
WITH {_ELEMENTS},
ruled AS (
  SELECT *, CASE WHEN page_id % 2 = 0 THEN n ELSE 4 - n END AS rule_no
  FROM (SELECT *, CASE selector WHEN 'absent' THEN 1 WHEN 'heading' THEN 2 ELSE 3 END AS n FROM elements)),
ranked AS (SELECT *, rank() OVER (PARTITION BY page_id ORDER BY rule_no) AS r FROM ruled)
SELECT page_id, rule_no, selector, ordinal, text FROM ranked WHERE r = 1""",
    "link_filter": f"WITH {_LINKS} SELECT dest_seq, scroll_no, pos, href FROM links WHERE contains(href, '/e')",
    "canonical_url": "SELECT page_id, split_part(url, '?', 1) AS canonical FROM pages",
    "discover_rules": f"WITH {_RULED} SELECT * FROM ruled",
    "discover_links": f"""
WITH {_RULED} SELECT split_part(href, '?', 1) AS canonical, dest_seq, scroll_no, pos, href FROM ruled WHERE contains(href, '/hotel/')
QUALIFY row_number() OVER (PARTITION BY split_part(href, '?', 1) ORDER BY dest_seq, scroll_no, pos) = 1""",
    "first_seen_links": f"WITH {_FIRST_SEEN} SELECT * FROM first_seen",
    "first_n_links": f"WITH {_FIRST_SEEN} SELECT * FROM first_seen ORDER BY dest_seq, scroll_no, pos LIMIT 200",
    "first_n_per_destination": f"""
WITH {_FIRST_SEEN},
ranked AS (SELECT *, row_number() OVER (PARTITION BY dest_seq ORDER BY scroll_no, pos) AS rn FROM first_seen)
SELECT canonical, dest_seq, scroll_no, pos, href FROM ranked WHERE rn <= 20""",
    "page_state": f"SELECT doc_id, {_STATE} AS state FROM documents",
    "page_state_counts": f"SELECT {_STATE} AS state, count(*) AS n_pages FROM documents GROUP BY ALL",
    "destination_coverage": """
SELECT n_nationkey AS dest_seq, n_name AS city, count(c_custkey) AS n_links, count(c_custkey) > 0 AS covered
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
    "visited_views": f"""
WITH views AS (
  SELECT CAST(doc_id // 12 AS INTEGER) AS dest_seq, CAST(doc_id % 12 + 1 AS INTEGER) AS scroll_no, lang = 'en' AS matched,
    {_STATE} AS state, CASE WHEN lang = 'en' AND doc_id // 12 > 1 THEN n_chars ELSE 0 END AS n_links
  FROM documents),
stops AS (
  SELECT dest_seq, min(CASE WHEN NOT matched AND state = 'empty' THEN scroll_no END) AS stop FROM views GROUP BY ALL),
within AS (
  SELECT views.* FROM views JOIN stops USING (dest_seq) WHERE scroll_no <= 10 AND (stop IS NULL OR scroll_no <= stop))
SELECT * FROM within
WHERE scroll_no <= 4 OR dest_seq >= (SELECT min(dest_seq) FROM within WHERE scroll_no <= 4 AND n_links > 0)""",
    "price_digits": f"""
SELECT l_orderkey, l_linenumber, l_suppkey, {_PRICE_TEXT} AS price_text, {_digits(_PRICE_TEXT)} AS price FROM lineitem""",
    "price_min_max": f"""
WITH priced AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS tier, {_digits(_PRICE_TEXT)} AS amount
  FROM lineitem),
tiers AS (SELECT *, min(CASE WHEN amount IS NOT NULL THEN tier END) OVER (PARTITION BY l_orderkey) AS lowest FROM priced)
SELECT l_orderkey, min(CASE WHEN tier = lowest THEN amount END) AS min_price,
  max(CASE WHEN tier = lowest THEN amount END) AS max_price FROM tiers GROUP BY ALL""",
    "currency_scan": """
WITH found AS (
  SELECT doc_id, list_transform(regexp_extract_all(text || ' $' || n_chars || ' € ' || doc_id || ' £' || n_chars * 1000 || ',5',
    '[€$£]\\s?([0-9]{2,5})', 1), lambda x: CAST(x AS BIGINT)) AS amounts FROM documents)
SELECT doc_id, CAST(len(amounts) AS INTEGER) AS n_amounts, list_min(amounts) AS min_amount, list_max(amounts) AS max_amount
FROM found""",
    "category_extract": f"""
WITH texts AS (SELECT p_partkey, {_CATEGORY_TEXT} AS t FROM part)
SELECT p_partkey, {_category("t")} AS category FROM texts""",
    "category_normalize": """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Riad' WHEN 'SMALL' THEN 'Apartment-Hotel' ELSE p_type END AS category
FROM part""",
    "coordinates": f"""
SELECT s_suppkey, {_point("s_acctbal", "s_acctbal", "s_suppkey", "s_suppkey % 5")} AS latitude,
  {_point("CAST(s_suppkey AS DOUBLE)", "s_acctbal", "s_suppkey", "s_suppkey % 5")} AS longitude FROM supplier""",
    "wifi_speed": """
SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN CAST(n_chars AS VARCHAR) || ' Mbps' ELSE 'Not specified' END AS wifi_speed
FROM documents""",
    "score_cast": f"""
WITH texts AS (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN ' ' || chr(9) || ' ' || CAST(value AS VARCHAR) || chr(160) || chr(10)
    WHEN 1 THEN CAST(value AS VARCHAR) || 'f' WHEN 2 THEN 'n/a' WHEN 3 THEN '1_000'
    WHEN 4 THEN '-' || CAST(value AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS t FROM events)
SELECT event_id, CASE WHEN regexp_matches(trim(t, {_WS}), '{_FLOAT}') THEN CAST(trim(t, {_WS}) AS DOUBLE) END AS score
FROM texts""",
    "count_digits": f"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {_digits("format('{:,}', o_orderkey)")} END AS review_count
FROM orders""",
    "subscores": """
WITH lists AS (SELECT vec_id, CASE WHEN label % 3 = 0 THEN embedding[1:6] ELSE embedding END AS e FROM embeddings)
SELECT vec_id, CAST(e[4] AS DOUBLE) AS comfort_score, CAST(e[5] AS DOUBLE) AS value_score,
  CAST(e[6] AS DOUBLE) AS location_score, CAST(e[7] AS DOUBLE) AS wifi_score FROM lists""",
    "review_gate": """
WITH carded AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o_orderkey AS property_id, CASE WHEN l_orderkey IS NOT NULL THEN o_totalprice END AS general_review,
  CASE WHEN l_orderkey IS NOT NULL THEN o_custkey END AS general_review_count
FROM orders LEFT JOIN carded ON l_orderkey = o_orderkey""",
    "html_attributes": _HTML_ATTRIBUTES,
    "selected_attributes": _HTML_ATTRIBUTES,
    "geo_lookup_join": f"""
WITH {_PLACES},
properties AS (
  SELECT c_custkey AS property_id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey AS DOUBLE) END AS latitude,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey + 0.5 AS DOUBLE) END AS longitude FROM customer)
SELECT property_id, latitude, longitude, address, zone, city
FROM properties LEFT JOIN places ON latitude = lat AND longitude = lon""",
    "json_fields": """
WITH bodies AS (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '{"display_name":"User ' || user_id || '"'
    ELSE '{"display_name":"User ' || user_id || '","address":' || props || '}' END AS body FROM events)
SELECT event_id, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.display_name') END AS display_name,
  CASE WHEN json_valid(body) THEN json_extract_string(body, '$.address.k') END AS address_k FROM bodies""",
    "address_clean": f"SELECT doc_id, replace(trim({_latin('text')}, {_WS}), ',', ' ') AS address FROM documents",
    "zone_coalesce": f"""
WITH {_ADDRESS_MAP}
SELECT c_custkey, coalesce(nullif(trim({_latin("neighbourhood")}), ''), nullif(trim({_latin("suburb")}), ''),
  CASE WHEN coalesce(nullif(neighbourhood, ''), nullif(suburb, '')) IS NOT NULL THEN '' END) AS zone FROM map""",
    "city_coalesce": f"""
WITH {_ADDRESS_MAP}
SELECT c_custkey, trim(coalesce(nullif(city, ''), nullif(town, ''), nullif(c_mktsegment, ''))) AS city FROM map""",
    "strip_text": f"""
SELECT doc_id, trim(' ' || chr(9) || chr(160) || chr(12288) || text || chr(13) || chr(10) || chr(160) || ' ', {_WS}) AS stripped
FROM documents""",
    "split_second": "SELECT doc_id, string_split(text, ' the ')[2] AS piece FROM documents",
    "field_names": """
SELECT p_partkey, replace(replace(lower(p_name || '-' || p_type), ' ', '_'), '-', '_') AS field_name FROM part""",
    "stamp_formats": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
  strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
    "year_extract": """
WITH texts AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Stayed in May ' || year(o_orderdate) WHEN 1 THEN 'May' || year(o_orderdate)
    WHEN 2 THEN '(1999) ' || year(o_orderdate) || '-2031' END AS t FROM orders)
SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(t, '\\b(20[0-9]{2})\\b', 1), '') AS INTEGER) AS stay_year FROM texts""",
    "review_score_parse": f"""
WITH {_CARDS}, {_PARSED}
SELECT property_id, list_kind, review_id, score, stay_date, stay_year, traveler_type FROM parsed""",
    "year_filter_lenient": f"""
WITH {_CARDS}, {_PARSED}
SELECT property_id, list_kind, review_id, score FROM parsed
WHERE list_kind = 'ALL' AND (stay_date = 'Unknown' OR stay_year = 2025)""",
    "year_filter_strict": f"""
WITH {_CARDS}, {_PARSED}
SELECT property_id, list_kind, review_id, score FROM parsed WHERE list_kind <> 'ALL' AND stay_year = 2025""",
    "known_types": f"""
WITH {_CARDS}, {_PARSED}
SELECT property_id, list_kind, review_id, traveler_type FROM parsed WHERE list_kind <> 'ALL' OR traveler_type <> 'Unknown'""",
    "business_offered": f"""
WITH {_CARDS}
SELECT property_id, list_kind, review_id FROM cards
WHERE list_kind = 'ALL' OR property_id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 4000)""",
    "newest_first": f"WITH {_CARDS} SELECT property_id, list_kind, review_id, review_ts FROM cards ORDER BY review_ts DESC, review_id",
    "newest_k_reviews": f"""
WITH {_CARDS} SELECT property_id, list_kind, review_id, CAST(seq AS INTEGER) AS seq FROM paged WHERE seq <= 20""",
    "first_review_pages": f"""
WITH {_CARDS}
SELECT property_id, list_kind, review_id, CAST((seq - 1) // 10 + 1 AS INTEGER) AS page_no,
  CAST((seq - 1) % 10 + 1 AS INTEGER) AS pos FROM paged WHERE seq <= 20""",
    "type_stats": f"""
WITH {_CARDS}, {_PARSED}, {_KEPT}
SELECT property_id, traveler_type, {_MEAN} AS avg_score, count(*) AS n FROM kept GROUP BY ALL""",
    "union_business": f"""
WITH {_CARDS}, {_PARSED}, {_KEPT}
SELECT property_id, CASE WHEN list_kind = 'ALL' THEN traveler_type ELSE 'Business travellers' END AS traveler_type,
  {_MEAN} AS avg_score, count(*) AS n FROM kept GROUP BY 1, 2""",
    "type_normalize": f"""
WITH {_CARDS}, {_PARSED}
SELECT property_id, list_kind, review_id, traveler_type, {_kind('traveler_type')} AS kind FROM parsed""",
    "type_collision_last": f"{_TO_RESOLVED} SELECT property_id, kind AS traveler_type, avg_score, n FROM resolved",
    "type_collision_merged": f"""
{_TO_RESOLVED}
SELECT property_id, kind AS traveler_type, {_MEAN_OF_CENTS} AS avg_score, CAST(sum(n) AS BIGINT) AS n FROM named GROUP BY 1, 2""",
    "totals_rollup": f"""{_TO_STATS}
SELECT property_id, traveler_type, CAST(grouping(property_id, traveler_type) AS INTEGER) AS level,
  {_MEAN_OF_CENTS} AS avg_score, CAST(sum(n) AS BIGINT) AS n FROM stats GROUP BY ROLLUP (property_id, traveler_type)""",
    "totals_by_place": f"""{_TO_STATS}
SELECT c_nationkey AS city, c_mktsegment AS zone, CAST(grouping(c_nationkey, c_mktsegment) AS INTEGER) AS level,
  {_MEAN_OF_CENTS} AS avg_score, CAST(sum(n) AS BIGINT) AS n
FROM stats JOIN customer ON CAST(c_custkey AS VARCHAR) = property_id
GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey), ())""",
    "traveler_type_map": f"""{_TO_RESOLVED}
SELECT property_id, {_pairs(_KINDS)}, CAST(count(*) FILTER (WHERE kind NOT IN {_KINDS}) AS INTEGER) AS n_other,
  max(n) FILTER (WHERE kind = 'digital_nomad') AS nomads
FROM resolved GROUP BY property_id""",
    "card_channel": f"""WITH {_CARDS},
read AS (SELECT *, TRY_CAST(split_part(score_text, 'Scored ', 2) AS DOUBLE) AS score FROM cards),
told AS (
  SELECT property_id, list_kind, review_id, score, {_kind('traveler_type')} AS kind,
    TRY_CAST(nullif(regexp_extract(stay_date, '\\b(20[0-9]{{2}})\\b', 1), '') AS INTEGER) AS stay_year, score_text
  FROM read)
SELECT property_id, list_kind, review_id, score, kind, stay_year,
  nullif(concat_ws(', ', CASE WHEN score IS NULL THEN 'unreadable score' END, CASE WHEN kind IS NULL THEN 'missing kind' END), '') AS reason,
  CASE WHEN score IS NULL THEN score_text END AS input
FROM told""",
    "file_channel": """
SELECT CASE WHEN event_id % 10 <> 3 THEN event_id END AS event_id, CASE WHEN event_id % 10 NOT IN (3, 7) THEN value END AS value,
  CASE WHEN event_id % 10 IN (3, 7) THEN 'unreadable line' END AS reason,
  CASE event_id % 10 WHEN 3 THEN 'x' || event_id || ',oops' WHEN 7 THEN event_id || ',n/a' END AS input
FROM events""",
    "all_stats": f"{_TO_STATS}, {_TOTALS} SELECT * FROM totals",
    "traveler_pivot": f"{_TO_RESOLVED}, {_WIDE} SELECT * FROM wide",
    "dynamic_columns": f"{_TO_RESOLVED}, {_WIDE_EXTRA} SELECT * FROM wide",
    "traveler_means_by_property": f"{_TO_RESOLVED}, {_TOTALS}, {_WIDE} SELECT * FROM totals JOIN wide USING (property_id)",
    "traveler_means_dynamic": f"{_TO_RESOLVED}, {_TOTALS}, {_WIDE_EXTRA} SELECT * FROM totals JOIN wide USING (property_id)",
    "html_review_cards": f"""
WITH {_CARDS}
SELECT property_id, list_kind, CAST((seq - 1) // 10 + 1 AS INTEGER) AS page_no, CAST((seq - 1) % 10 + 1 AS INTEGER) AS pos,
  CASE WHEN contains(score_text, 'Scored') THEN score_text END AS score_text, stay_date, traveler_type
FROM paged""",
    "property_record": _REVIEW_RECORD,
    "record_15": f"WITH {_SHORT} SELECT {_COLUMNS_15} FROM short",
    "record_31": _REVIEW_RECORD.replace(_KEPT, _KEPT_OF_ALL_YEARS).replace("2025 AS filtered_year", "CAST(NULL AS INTEGER) AS filtered_year"),
    "export_defaults": f"""
WITH {_SHORT}
SELECT property_id, scrape_timestamp, property_url,
  {", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in ("category", "latitude", "longitude", "address", "zone", "city", "wifi_speed"))},
  {", ".join(f"coalesce(CAST({c} AS VARCHAR), '0') AS {c}" for c in ("general_review", "general_review_count", "wifi_score", "min_price", "max_price"))}
FROM short""",
    "import_nulls": f"""
WITH {_SHORT}
SELECT {", ".join(f"nullif({c}, 0) AS {c}" if c in ("general_review", "general_review_count", "wifi_score", "min_price", "max_price") else c
  for c in (x.strip() for x in _COLUMNS_15.split(",")))} FROM short""",
    "run_id": """
SELECT o_orderkey, CAST(count(*) AS INTEGER) AS n_cities,
  lower(string_agg('City ' || l_suppkey, '-' ORDER BY l_linenumber, 'City ' || l_suppkey)) || '_' ||
  strftime(min(o_orderdate), '%Y%m%d_%H%M%S') AS run_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "csv_runs": _CSV_RUNS,
    "run_keys": """
WITH s AS (
  SELECT o_orderkey, l_linenumber, 'City ' || l_suppkey AS city, o_orderdate,
    ('0x' || substr(md5(l_linenumber || '|' || lower('City ' || l_suppkey)), 1, 15))::BIGINT::HUGEINT AS h
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
k AS (
  SELECT o_orderkey, CAST(count(*) AS INTEGER) AS n_cities, arg_min(city, (l_linenumber, city)) AS first_city,
    arg_max(city, (l_linenumber, city)) AS last_city, lower(to_hex((sum(h) % 1152921504606846976)::BIGINT)) AS digest, min(o_orderdate) AS started
  FROM s GROUP BY o_orderkey)
SELECT o_orderkey, n_cities, first_city, last_city, digest,
  lower(first_city || '-' || last_city) || '_' || digest || '_' || strftime(started, '%Y%m%d_%H%M%S') AS run_id FROM k""",
    "run_summary": """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, count(*) AS n_total,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100 / count(*), 1) AS percent
FROM orders GROUP BY ALL""",
    "error_rows": f"""
WITH {_BASE},
reasons AS (
  SELECT page_id, list_filter([CASE WHEN category IS NULL THEN 'category' END, CASE WHEN latitude IS NULL THEN 'latitude' END,
    CASE WHEN min_price IS NULL THEN 'min_price' END], lambda x: x IS NOT NULL) AS missing FROM attributes)
SELECT page_id, 'missing ' || array_to_string(missing, ', ') AS reason FROM reasons WHERE len(missing) > 0""",
    "batch_metrics": """
SELECT CAST(o_orderkey % 4 AS INTEGER) AS batch_id, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, count(*) AS n_total,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100 / count(*), 1) AS percent
FROM orders GROUP BY 1""",
    "first_n_split": f"WITH {_LINKS} SELECT dest_seq, scroll_no, pos, href FROM links ORDER BY dest_seq, scroll_no, pos LIMIT 1000",
    "seen_across_runs": f"""
WITH {_LINKS},
told AS (SELECT *, split_part(href, '?', 1) AS canonical, CAST((scroll_no * 7 + dest_seq) % 3 AS INTEGER) AS run FROM links)
SELECT run, canonical, dest_seq, scroll_no, pos, href FROM told
QUALIFY row_number() OVER (PARTITION BY canonical ORDER BY run, dest_seq, scroll_no, pos, href) = 1""",
    "traveler_means_incremental": f"{_TO_RESOLVED}, {_TOTALS}, {_WIDE} SELECT * FROM totals JOIN wide USING (property_id)",
    "stream_first_seen": f"""
WITH {_LINKS},
seen AS (
  SELECT split_part(href, '?', 1) AS canonical, dest_seq, scroll_no, pos, href, row_number() OVER (
    PARTITION BY split_part(href, '?', 1) ORDER BY CAST(split_part(href, '?p=', -1) AS INTEGER) % 4, dest_seq, scroll_no, pos) AS r
  FROM links)
SELECT canonical, dest_seq, scroll_no, pos, href FROM seen WHERE r = 1""",
    "stream_records": _HTML_ATTRIBUTES,
}
