from __future__ import annotations

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from staylens.functions.markup import _compile, page_elements, select_elements
from staylens.functions.rules import LINK_RULES, PROPERTY_RULES, REVIEW_CARD_RULE, Rule
from staylens.operators.links import harvest_links

PAGE = """<!DOCTYPE html><html><body>
<div class="x sr_property_block" data-testid="property-card">
  <h3 data-testid="title"><a href="/hotel/a.html?x&amp;y">A <b>b</b></a></h3>
</div>
<!-- <a data-testid="title-link" href="/hotel/hidden"> -->
<script>var s = '<a data-testid="title-link" href="/hotel/script">';</script>
<div id="js--hp-gallery-scorecard"><a href="#tab-reviews"><div><div><div>
  <div>Good</div><div> 8.4 </div><div>of</div><div><i>x</i><div>n</div><div>1,234 reviews</div></div>
</div></div></div></a></div>
<div>  <span>70 Mbps</span></div><div>Free <!-- c --> • 60 Mbps</div><div>Free • 50 Mbps<br></div>
<p>one<p class='k'>two<li>three</body></html>"""


def found(html, *rules, scope=None):
    compiled = [(r.name, _compile(r.css), r.attr, r.own_text) for r in rules]
    return page_elements(html, compiled, _compile(scope) if scope else None)


def test_page_rules():
    hits = {(name, n): (text, attr) for name, n, _, text, attr in found(PAGE, *LINK_RULES, *PROPERTY_RULES)}
    assert hits["2", 1] == ("A b", "/hotel/a.html?x&y")
    assert ("1", 1) not in hits  # only in a comment and a script
    assert hits["score", 1][0] == " 8.4 "
    assert hits["count", 1][0] == "1,234 reviews"
    # the first text node decides: a child's text and text after a comment do not count
    assert hits["wifi", 1][0] == "Free • 50 Mbps"
    assert ("wifi", 2) not in hits


@pytest.mark.parametrize(
    "css, texts",
    [
        ("p", ["one", "two"]),
        ("p.k", ["two"]),
        ("p:not([class])", ["one"]),
        ("body > p", ["one", "two"]),
        ("div > span", ["70 Mbps"]),
        ("html > span", []),
        ("div div span", []),
        ("p:nth-of-type(2)", ["two"]),
        ("[data-testid]  b", ["b"]),
    ],
)
def test_selectors(css, texts):
    got = [e[3] for e in found(PAGE, Rule("r", css))]
    assert [t.strip() for t in got][: len(texts)] == texts and len(got) == len(texts)


def test_quotes_entities_and_scope():
    html = (
        '<div data-testid="review-card"><div>Scored 8</div><i data-x="a>b">u</i></div>'
        '<div data-testid="review&#45;card"><div>Scored 9</div></div><div>Scored 1</div>'
    )
    rules = (REVIEW_CARD_RULE, Rule("s", "div", own_text="Scored"), Rule("x", "[data-x='a>b']"))
    got = [(e[0], e[2], e[3]) for e in found(html, *rules, scope=REVIEW_CARD_RULE.css)]
    assert got == [
        ("review_card", 1, "Scored 8u"), ("s", 1, "Scored 8"), ("x", 1, "u"),
        ("review_card", 2, "Scored 9"), ("s", 2, "Scored 9"), ("s", 0, "Scored 1"),
    ]


def test_broken_markup_is_read_as_far_as_possible():
    html = "<div><a href='/hotel/1'>x</div></b><a href=/hotel/2 class=>y<a href=\"/hotel/3"
    assert [e[4] for e in found(html, Rule("a", 'a[href*="/hotel/"]', "href"))] == ["/hotel/1", "/hotel/2"]


def test_closing_slash_counts_in_drawings_only():
    html = "<div><svg><path d='x'/><g></g></svg><div/><b>in</b></div><a href=/hotel/>t</a>"
    assert [e[3] for e in found(html, Rule("b", "div > div > b"))] == ["in"]
    assert [e[3] for e in found(html, Rule("g", "svg > g"))] == [""]
    assert [(e[3], e[4]) for e in found(html, Rule("a", "a", "href"))] == [("t", "/hotel/")]


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href"):
            self.hrefs.append(dict(attrs)["href"])


def test_same_anchors_as_the_standard_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = pages.select("html", select_elements(F.col("html"), [Rule("a", "a[href]", "href")]).alias("e")).collect()
    for row in got:
        parser = _Anchors()
        parser.feed(row.html)
        assert [e.attr for e in row.e] == parser.hrefs


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<a href='/hotel/x'>t</a>")], "i int, html string")
    got = df.select("i", select_elements(F.col("html"), LINK_RULES).alias("e")).orderBy("i").collect()
    assert got[0].e is None and got[1].e == [] and [x.rule for x in got[2].e] == ["5"]


def test_first_matching_rule_ends_the_search(spark):
    rows = [
        # rule 2 matches only a non-listing link: nothing for this view
        (1, 1, '<h3 data-testid="title"><a href="/about">x</a></h3><a href="/hotel/1">y</a>'),
        (1, 2, '<a href="/hotel/2#r">z</a><a href="/hotel/3">y</a>'),
    ]
    views = spark.createDataFrame(rows, "dest_seq int, scroll_no int, html string")
    got = [tuple(r) for r in harvest_links(views).orderBy("scroll_no", "pos").collect()]
    assert got == [(1, 1, 0, "/about"), (1, 2, 0, "/hotel/3")]
