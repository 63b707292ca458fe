"""Element rows and rules as a table, against the page-by-page reading."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from staylens.functions.rules import LINK_RULES, Rule
from staylens.operators import elements as E
from staylens.operators.links import harvest_links

KEYS = ["dest_seq", "scroll_no"]
PAGES = [
    '<h3 data-testid="title"><a href="/hotel/1">x</a></h3><a data-testid="title-link" href="/hotel/2?v=1">t</a>',
    '<h3 data-testid="title"><a href="/hotel/3">x</a></h3><h3 data-testid="title"><span><a href="/hotel/4">y</a></span></h3>',
    '<h3 data-testid="title"><img src=x><br><a href="/hotel/5">x</a></h3>',
    '<div data-testid="property-card"><p><b><a href="/hotel/6?x=1&amp;y=2">c</a></b></div><a href="/hotel/7">o</a>',
    '<div data-testid="property-card"><div></div></div><div><a href="/hotel/8">c</a></div><a href="/hotel/9#x">o</a>',
    '<a class="k e13098a59f z" href="/hotel/10#f">e</a><a href="/hotel/11">f</a>',
    "<a href='/hotel/12'>p</a><A HREF=/hotel/13#map>q</A><!-- <a data-testid=\"title-link\" href=z> -->",
    '<div class="sr_property_block x"><div><a class="hotel_name_link" href="/hotel/14#a">h</a></div></div>',
    '<a class="js-sr-hotel-link" href="/hotel/15#b">j</a><script>var a = "<a href=\'/hotel/16\'>"</script>',
    '<a data-testid="title-link">no link</a><a href="/hotel/17">lost</a>',
    "no markup at all",
    "",
    '</div><div data-testid="property-card"><li><a href="/hotel/18">a</a><li><a href="/hotel/19">b</a></div>',
]


def views(spark, pages):
    return spark.createDataFrame([(i % 3, i, html) for i, html in enumerate(pages)], "dest_seq int, scroll_no int, html string")


def both(spark, pages, rules=LINK_RULES):
    read = views(spark, pages)
    got = sorted((r.dest_seq, r.scroll_no, r.pos, r.href) for r in E.rule_links(read, KEYS, rules).fillna("").collect())
    want = sorted((r.dest_seq, r.scroll_no, r.pos, r.href) for r in harvest_links(read, rules).fillna("").collect())
    return got, want


def test_seven_rules_as_the_page_reading(spark):
    got, want = both(spark, PAGES)
    assert got == want and len(got) == 12
    rules = {r.rule_no for r in E.rule_links(views(spark, PAGES), KEYS).collect()}
    assert rules == {1, 2, 3, 4, 5, 6, 7}


def test_random_pages_as_the_page_reading(spark):
    rng = random.Random(6)

    def block(depth):
        if depth == 0 or rng.random() < 0.2:
            kind = rng.choice(['class="hotel_name_link"', 'data-testid="title-link"' if rng.random() < 0.1 else "", 'class="x e13098a59f"', ""])
            return f'<a {kind} href="/{rng.choice(["hotel", "x"])}/{rng.randrange(99)}{rng.choice(["", "#a", "?b"])}">t</a>'
        tag = rng.choice(['div data-testid="property-card"', 'div class="sr_property_block"', "div", "span", 'h3 data-testid="title"', "section"])
        inner = "".join(block(depth - 1) for _ in range(rng.randrange(1, 4)))
        return f"<{tag}>{'<br>' * rng.randrange(2)}{inner}</{tag.split()[0]}>"

    got, want = both(spark, ["".join(block(3) for _ in range(rng.randrange(4))) for _ in range(150)])
    assert got == want and len(got) > 100


def test_parents_and_ends(spark):
    html = "<div><p>a<p>b<span><img><i>c</i></span></div><ul><li>1<li>2</ul>"
    tags = E.page_tags(views(spark, [html]), KEYS)
    rows = {r.pos: (r.tag, r.end, r.parent) for r in E.elements(tags, KEYS).collect()}
    assert rows[0] == ("div", 8, None) and rows[3][0] == "span" and rows[3][1] == 7
    assert rows[4] == ("img", 4, 3) and rows[5] == ("i", 6, 3)


def test_rules_that_need_more_are_refused(spark):
    for css in ("a b c", "div:nth-of-type(2)"):
        with pytest.raises(ValueError, match="one or two"):
            E.rule_table(spark, [Rule("x", css)])


def test_no_python_worker(spark):
    read = E.elements(E.page_tags(views(spark, PAGES), KEYS), KEYS)
    hits = E.rule_hits(read, E.rule_table(spark, LINK_RULES), KEYS)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    none = views(spark, PAGES).where(F.lit(False))
    assert E.rule_links(none, KEYS).count() == 0


def test_tasks_hold_a_bounded_part_and_tags_are_read_once(spark, monkeypatch):
    """More pages are dealt to more tasks, and nesting reads the tags of a page once."""
    pages = views(spark, PAGES)
    tags = E.page_tags(pages, KEYS)
    least = spark.sparkContext.defaultParallelism
    assert [E.dealt(tags, KEYS, total, 100).rdd.getNumPartitions() for total in (None, 100, 10_050)] == [least, least, max(least, 101)]
    plan = E.elements(tags, KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("regexp_extract_all") == 1
    whole = sorted(map(tuple, E.rule_links(pages, KEYS).collect()))
    monkeypatch.setattr(E, "TASK_CHARS", 50)
    assert sorted(map(tuple, E.rule_links(pages, KEYS).collect())) == whole
