"""No page may end an executor: runs of a million characters through every expression that reads pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staylens.functions.markup import anchor_hrefs
from staylens.functions.text import strip
from staylens.operators import attributes as A
from staylens.operators import crawl, links, prices
from staylens.plans.discovery import body_text, discover

N = 1_000_000
LONG = {
    "open attribute": "<a href=/x data-y=" + "z" * N,
    "bare attribute": "<a href=/x data-y=" + "z" * N + ">",
    "quoted attribute": '<a href="/x" title="' + "z" * N + '">',
    "many attributes": "<a href=/x " + 'b="c" ' * (N // 6) + ">",
    "quotes": "<a href=/x " + "\"'" * (N // 2),
    "blanks": "a" + " " * N + "b",
    "entities": "a" + "&nbsp; " * (N // 7) + "b",
    "comment": "<!--" + "-" * N,
    "script": "<script>" + "<" * N,
    "tags": "<" * N,
    "anchors": "<a href=/x>" * (N // 11),
    "digits": "€" + "1" * N,
    "coordinates": '"latitude":' + "1." * (N // 2),
}


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    """Stored, so that expressions run in the executors and not over literals."""
    at = str(tmp_path_factory.mktemp("long") / "pages")
    rows = [(i, f"https://stays.example/{i}", html) for i, html in enumerate(LONG.values())]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4).write.parquet(at)
    return spark.read.parquet(at)


def test_long_pages(spark, pages):
    html = F.col("html")
    read = pages.select(
        "page_id",
        F.size(anchor_hrefs(html)).alias("n"),
        F.length(body_text(html)).alias("body"),
        crawl.page_state(body_text(html)).alias("state"),
        F.size(prices.currency_amounts(html)).alias("amounts"),
        A.coordinates(html).alias("point"),
        F.length(strip(html)).alias("stripped"),
    )
    rows = {name: row for name, row in zip(LONG, read.orderBy("page_id").collect(), strict=True)}
    assert rows["bare attribute"].n == rows["quoted attribute"].n == rows["many attributes"].n == 1
    assert rows["anchors"].n == N // 11 and rows["open attribute"].n == 0
    assert rows["blanks"].body == rows["entities"].body == 3
    assert rows["tags"].body == 1 and rows["blanks"].stripped == N + 2
    assert rows["digits"].amounts == 1


def test_long_pages_through_links_and_discovery(spark, pages):
    found = links.explode_anchors(pages.select("page_id", "html"))
    order = found.select(F.lit(0).alias("dest_seq"), F.col("page_id").cast("int").alias("scroll_no"), "pos", "href")
    assert [r.href for r in links.first_n(links.first_seen(order), 5).collect()] == ["/x"]
    chosen = links.first_tag_rule_hrefs(F.col("html"), ('data-testid="title-link"', "href="))
    assert pages.select(F.posexplode(chosen)).count() == N // 11 + 3
    views = pages.where("page_id <> 4").select(F.lit(0).alias("dest_seq"), F.col("page_id").cast("int").alias("scroll_no"), "html")
    assert discover(views).count() == 0
