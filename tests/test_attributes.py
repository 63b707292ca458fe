from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions import rules as R
from staylens.operators import attributes as A
from staylens.operators import prices as P


def test_tiers_do_not_mix(spark):
    rows = [(1, 1, 900), (1, 2, 100), (2, 2, 70), (2, 3, 5), (2, 2, 90), (3, 3, 44), (4, 1, None), (4, 2, 8), (5, 1, None)]
    df = spark.createDataFrame(rows, "page_id int, tier int, amount bigint")
    got = {r.page_id: (r.min_price, r.max_price) for r in P.price_range(df, "page_id").collect()}
    assert got == {1: (900, 900), 2: (70, 90), 3: (44, 44), 4: (8, 8), 5: (None, None)}


def test_currency_amounts(evaluate):
    values = ["€ 450", "$12345678", "£1,234", "$7", "€72.50 and $ 99", "no", None]
    assert evaluate(values, P.currency_amounts) == [[450], [12345], [], [], [72, 99], [], None]


def test_category(evaluate):
    values = ["Inn (A) (Guest House) (X)", "Inn (Hotel)", "Inn", "", None, " Inn () (B) ", "(a)(b)(c)"]
    assert evaluate(values, A.category) == ["Guest House", "Hotel", "Inn", "", None, "B", "b"]
    assert evaluate(["Guest House", "Guesthouse", "Condo Hotel", None], A.normal_category) == [
        "Riad", "Guesthouse", "Apartment-Hotel", None,
    ]


def test_category_on_random_text(evaluate):
    def spec(text):
        found = re.findall(r"\(([^)]+)\)", text)
        return found[-2] if len(found) > 1 else found[0] if found else text

    rng = random.Random(4)
    values = ["".join(rng.choices("ab()", k=rng.randrange(16))) for _ in range(400)]
    assert evaluate(values, A.category) == [spec(v) for v in values]


def test_coordinates_fall_through_and_guard(spark):
    rows = [
        (1, '"latitude":1.2.3,"longitude":4 "lat":5.5,"lng":6'),
        (2, '"latitude":0.0,"longitude":5.0'),
        (3, '"lat":-5,"lng":.25'),
        (4, "none"),
        (5, '"latitude":0,"longitude":5.0 "lat":1,"lng":2'),  # readable zeros end the search
        (6, None),
        (7, '"latitude":1,"longitude":2;"latitude":3,"longitude":4'),
    ]
    df = spark.createDataFrame(rows, "i int, html string").select("i", A.coordinates(F.col("html")).alias("p"))
    lat, lon = A.guarded(F.col("p"))
    got = [(r.a, r.b) for r in df.select("i", lat.alias("a"), lon.alias("b")).orderBy("i").collect()]
    assert got == [(5.5, 6.0), (None, None), (-5.0, 0.25), (None, None), (None, None), (None, None), (1.0, 2.0)]


def test_wifi(evaluate):
    values = ["Free • 70 Mbps", "70 Mbps", None, "a • b •  9 Mbps "]
    assert evaluate(values, A.wifi_speed) == ["70 Mbps", "70 Mbps", "Not specified", "9 Mbps"]


def test_subscores_past_the_end(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0],)], "v array<double>")
    assert tuple(df.select(*A.subscores(F.col("v"))).first()) == (4.0, 5.0, 6.0, None)


def _page(extra=""):
    sub = "".join(f'<div data-testid="review-subscore"><p>n</p><div aria-hidden="true"> {n}.5 </div></div>' for n in range(1, 8))
    return f"""<body><span data-testid="breadcrumb-current"><span>Dar X (Marrakech) (Guest House) (Morocco)</span></span>
<table><tr><td class="hprt-table-cell-price x"><div class="hprt-price-block"><div class="prco-wrapper">
<span class="prco-valign-middle-helper">MAD 1,450</span><span class="prco-valign-middle-helper"> </span></div></div></td>
<td class="hprt-table-cell-price"><span class="prc-no-css">MAD 9</span></td></tr></table>
<div id="js--hp-gallery-scorecard"><a><div><div><div><div>Good</div><div>8.4</div><div>of</div>
<div><div>from</div><div>2,964 reviews</div></div></div></div></div></a></div>
<div>Free • 70 Mbps</div>{sub}<script>{{"latitude":31.5,"longitude":-7.25}}</script>€ 99 {extra}</body>"""


EXPECTED = {
    "category": "Riad", "general_review": 8.4, "general_review_count": 2964, "comfort_score": 4.5,
    "value_score": 5.5, "location_score": 6.5, "wifi_score": 7.5, "min_price": 1450, "max_price": 1450,
    "latitude": 31.5, "longitude": -7.25, "wifi_speed": "70 Mbps",
}


def test_page_attributes(spark):
    card = '<div data-testid="review-card"></div>'
    rows = [(1, "u1", _page(card)), (2, "u2", _page()), (3, "u3", "€ 20 $ 35"), (4, "u4", None)]
    got = A.page_attributes(spark.createDataFrame(rows, schemas.PAGES)).orderBy("page_id").collect()
    assert {k: got[0][k] for k in EXPECTED} == EXPECTED and got[0].has_reviews and got[0].readable
    assert not got[1].has_reviews
    assert (got[2].min_price, got[2].max_price, got[2].wifi_speed, got[2].category) == (20, 35, "Not specified", None)
    assert got[3].readable is False and got[3].min_price is None


def test_element_rows_give_the_same_attributes(spark):
    rows = [
        (1, "category", 1, "Dar X (Marrakech) (Guest House) (Morocco)"),
        (1, "price_primary", 1, "MAD 1,450"),
        (1, "price_generic_2", 1, "MAD 9"),
        (1, "price_scan", 1, "99"),
        (1, "score", 1, "8.4"),
        (1, "score", 2, "1.0"),
        (1, "count", 1, "2,964 reviews"),
        (1, "wifi", 1, "Free • 70 Mbps"),
        (1, "wifi", 2, "Free • 1 Mbps"),
        (1, "coordinates", 1, '"latitude":31.5,"longitude":-7.25'),
    ] + [(1, "subscore", n, f" {n}.5 ") for n in range(1, 8)]
    df = spark.createDataFrame(rows, "page_id bigint, selector string, ordinal int, text string").repartition(4)
    row = A.element_attributes(df).first().asDict()
    assert {k: row[k] for k in EXPECTED} == EXPECTED


def test_review_gate(spark):
    df = spark.createDataFrame([(1, 8.0, True), (2, 7.0, False)], "i int, general_review double, has boolean")
    got = A.review_gate(df, F.col("has"), ("general_review",)).orderBy("i").collect()
    assert [r.general_review for r in got] == [8.0, None]


def test_price_rules_cover_seven_generic_selectors():
    assert len(R.PRICE_GENERIC_RULES) == 7 and len(R.LINK_RULES) == 7
