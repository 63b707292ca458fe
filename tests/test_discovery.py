from __future__ import annotations

from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import crawl, links, requests
from staylens.plans.discovery import discover
from staylens.plans.jobs import listing_pages


def test_search_requests(spark):
    places = spark.createDataFrame([(0, "El Jadida")], schemas.DESTINATIONS)
    row = requests.search_requests(places, "2025-12-31").first()
    assert row.url == (
        "https://listings.example/searchresults.html?ss=El Jadida&checkin=2025-12-31&checkout=2026-01-01"
        "&group_adults=1&no_rooms=1&group_children=0"
    )
    assert "ss=El+Jadida&" in requests.search_requests(places, "2025-12-31", encode=True).first().url


def test_canonical(evaluate):
    assert evaluate(["h/x?a?b", "h/x#f", "h/x", None], links.canonical_url) == ["h/x", "h/x#f", "h/x", None]


def test_first_seen_keeps_first_full_href_and_limit_starves(spark):
    rows = [(0, 1, 0, "h/x?1"), (0, 1, 1, "h/x?2"), (0, 1, 2, "h/y"), (0, 2, 0, "h/z"), (1, 1, 0, "h/y?9"), (1, 1, 1, "h/w")]
    seen = links.first_seen(spark.createDataFrame(rows, schemas.LINKS).repartition(3))
    assert {r.href for r in seen.collect()} == {"h/x?1", "h/y", "h/z", "h/w"}
    assert [r.href for r in links.first_n(seen, 3).collect()] == ["h/x?1", "h/y", "h/z"]
    assert len(links.first_n(seen, 0).collect()) == 4
    assert {r.href for r in links.first_n_per_destination(seen, 1).collect()} == {"h/x?1", "h/w"}


def test_page_state_order(evaluate):
    values = ["Verify: no results", "No Properties Found", "CAPTCHA", "fine", None]
    assert evaluate(values, crawl.page_state) == ["blocked", "empty", "blocked", "ok", "ok"]


def _walk(views):
    """Brute force: visit views one by one, each decided by those visited before it."""
    visited = []
    for view in sorted(views):
        dest, scroll = view[:2]
        before = [v for v in visited if v[0] == dest]
        ended = any(not v[2] and v[3] == "empty" for v in before)
        hopeless = len(before) > 3 and not any(v[4] for v in visited[: visited.index(before[-1]) + 1])
        if scroll <= 10 and not ended and not hopeless:
            visited.append(view)
    return {v[:2] for v in visited}


def test_visited_views_like_the_loop(spark):
    import random

    rng = random.Random(5)
    for _ in range(6):
        views = []
        for dest in range(4):
            for scroll in range(1, 13):
                matched = rng.random() < 0.4
                state = rng.choice(["ok", "ok", "ok", "blocked", "empty"])
                views.append((dest, scroll, matched, state, rng.choice([0, 0, 0, 2]) if matched else 0))
        df = spark.createDataFrame(views, "dest_seq int, scroll_no int, matched boolean, state string, n_links int")
        got = {(r.dest_seq, r.scroll_no) for r in crawl.visited_views(df, 10, 3).collect()}
        assert got == _walk(views)
        stops = {d: min((v[1] for v in views if v[0] == d and not v[2] and v[3] == "empty"), default=99) for d in range(4)}
        every = {(r.dest_seq, r.scroll_no) for r in crawl.visited_views(df).collect()}
        assert every == {v[:2] for v in views if v[1] <= stops[v[0]]}


def test_discover_and_listing_pages(spark):
    link = '<a data-testid="title-link" href="/hotel/{0}?v={1}">t</a>'
    views = [
        (0, 1, link.format("a", 1) + link.format("b", 1) + '<a data-testid="title-link">none</a>'),
        (0, 2, link.format("a", 2) + link.format("c", 2)),
        (1, 1, "<body>No results</body>"),
        (1, 2, link.format("never", 1)),
        (2, 1, link.format("b", 3) + link.format("d", 3)),
    ]
    df = spark.createDataFrame(views, schemas.SEARCH_VIEWS)
    got = discover(df).orderBy("dest_seq", "scroll_no", "pos").collect()
    assert [r.href for r in got] == ["/hotel/a?v=1", "/hotel/b?v=1", "/hotel/c?v=2", "/hotel/d?v=3"]
    assert [r.href for r in discover(df, limit=2).collect()] == ["/hotel/a?v=1", "/hotel/b?v=1"]
    pages = spark.createDataFrame(
        [(1, "/hotel/a", "old"), (2, "/hotel/a?z", "new"), (3, "/hotel/q", "other")], schemas.PAGES
    )
    kept = listing_pages(pages, discover(df)).collect()
    assert [(r.page_id, r.url, r.html) for r in kept] == [(2, "/hotel/a?v=1", "new")]


def test_relative_links_find_stored_pages_by_their_full_address(spark):
    views = spark.createDataFrame(
        [(0, 1, '<a data-testid="title-link" href="/hotel/a?x=1">t</a><a data-testid="title-link" href="//s.example/hotel/b">t</a>')],
        schemas.SEARCH_VIEWS,
    )
    pages = spark.createDataFrame([(1, "https://s.example/hotel/a", "A"), (2, "https://s.example/hotel/b?y", "B")], schemas.PAGES)
    found = discover(views, base="https://s.example/search/results.html?ss=x")
    got = {(r.page_id, r.url) for r in listing_pages(pages, found).collect()}
    assert got == {(1, "https://s.example/hotel/a?x=1"), (2, "https://s.example/hotel/b")}


def test_absolute_urls(evaluate):
    values = ["https://o.example/x", "mailto:a", "//h/x", "/x", "x?y", None]
    got = evaluate(values, lambda c: links.absolute_url(c, "https://s.example/a/b.html?q=/z"))
    assert got == ["https://o.example/x", "mailto:a", "https://h/x", "https://s.example/x", "https://s.example/a/x?y", None]
    assert evaluate(["/x"], lambda c: links.absolute_url(c, "https://s.example")) == ["https://s.example/x"]


def test_anchor_forms(spark):
    html = (
        "<!-- <a href='/no'>n</a> --><script>var x='<a href=\"/no\">'</script><a HREF='/x'>1</a><a href=/y>2</a>"
        '<a title="a > b" href="/z?a=1&amp;b=2">3</a><a data-href="/no" href="/w">4</a><a name="none">5</a><abbr href="/no">6</abbr>'
    )
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id long, html string")
    got = links.explode_anchors(pages).orderBy("page_id", "pos").collect()
    assert [(r.pos, r.href) for r in got] == [(0, "/x"), (1, "/y"), (2, "/z?a=1&b=2"), (3, "/w")]


def test_page_state_reads_the_body_only(evaluate):
    from staylens.plans.discovery import body_text

    values = ["<head><title>Please verify</title></head><body>No&nbsp;results</body>", "<body>No\n results</body>", "<p>verify</p>"]
    assert evaluate(values, lambda c: crawl.page_state(body_text(c))) == ["empty", "empty", "blocked"]


def test_coverage_counts_empty_destinations(spark):
    places = spark.createDataFrame([(0, "a"), (1, "b")], schemas.DESTINATIONS)
    found = spark.createDataFrame([(0, 1, 0, "x"), (0, 1, 1, "y")], schemas.LINKS)
    rows = crawl.destination_coverage(places, found).orderBy("dest_seq").collect()
    assert [(r.n_links, r.covered) for r in rows] == [(2, True), (0, False)]


def test_fallback_rows_keep_ties(spark):
    rows = [(1, 2, "a"), (1, 2, "b"), (1, 3, "c"), (2, 3, "d")]
    df = spark.createDataFrame(rows, "page_id int, rule_no int, text string")
    got = links.fallback_elements(df, ["page_id"]).select("text").collect()
    assert {r.text for r in got} == {"a", "b", "d"}


def test_tag_rules_stay_on_first_match(spark):
    df = spark.createDataFrame([(1, '<a class="u" href="/1">x</a><a href="/2" class="v">y</a>')], "i int, html string")
    pick = lambda *n: df.select(links.first_rule_hrefs(links.tag_rule_hrefs(F.col("html"), n)).alias("h")).first().h
    assert pick('class="v"', 'class="u"') == ["/2"]
    assert pick("none", "href") == ["/1", "/2"]
    assert pick("none") == []
