from __future__ import annotations

import datetime as dt
import random
import re
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions.rules import TRAVELER_TYPE_MAP
from staylens.operators import reviews as V
from staylens.plans.reviews import traveler_means, traveler_means_all_types

T0 = dt.datetime(2025, 1, 1)


def card(pid, kind, n, score, date, ttype):
    page, pos = divmod(n, 10)
    return (pid, kind, T0 - dt.timedelta(minutes=n), n, page + 1, pos + 1, score, date, ttype)


def cards_df(spark, rows):
    return spark.createDataFrame(rows, schemas.REVIEW_CARDS)


def number(text):
    """What stands between the first marker and the next, if it is a plain number."""
    found = re.search(r"Scored (.*?)(?:Scored |\Z)", text or "", re.S)
    return float(found[1]) if found and re.fullmatch(r"\s*\d+(\.\d+)?\s*", found[1]) else None


def counts(kind, date, ttype, target):
    date = (date or "").strip()
    fits = not target or re.findall(r"\b20\d\d\b", date)[:1] == [str(target)]
    if kind == "ALL":
        return bool((ttype or "").strip()) and (fits or not date)
    return fits


def spec(rows, target, pages=20):
    """Brute force per property: mean and count by normal type name, and over all."""
    met = defaultdict(lambda: defaultdict(list))
    for pid, kind, _, _, page, _, text, date, ttype in sorted(rows, key=lambda r: (r[1] != "ALL", r[4], r[5])):
        if page <= pages and number(text) is not None and counts(kind, date, ttype, target):
            met[pid][ttype.strip() if kind == "ALL" else "Business travellers"].append(number(text))
    out = {}
    for pid, by_raw in met.items():
        # later keys of a dict replace earlier ones, as later raw types do
        names = {re.sub("[ -]", "_", raw.lower()): raw for raw in by_raw}
        assert len(names) == len(by_raw)
        row = {TRAVELER_TYPE_MAP.get(name, name): fmean_count(by_raw[raw]) for name, raw in names.items()}
        out[pid] = {**row, "all": fmean_count(sum(by_raw.values(), []))}
    return out


def fmean_count(values):
    return statistics.fmean(values), len(values)


def as_dict(df):
    got = {}
    for r in df.collect():
        row = r.asDict()
        names = [c[len("avg_review_score_") :] for c in row if c.startswith("avg_") and not c.endswith("_count")]
        got[row["property_id"]] = {
            n: (row[schemas.mean_column(n)], row[schemas.count_column(n)])
            for n in names
            if row[schemas.count_column(n)] is not None
        }
    return got


def same(a, b):
    assert a.keys() == b.keys()
    for pid in a:
        assert a[pid].keys() == b[pid].keys(), pid
        for k in a[pid]:
            assert a[pid][k][1] == b[pid][k][1]
            assert a[pid][k][0] == pytest.approx(b[pid][k][0], abs=1e-9)


@pytest.mark.parametrize("target", [2025, None, 0])
def test_means_like_the_loop(spark, target):
    rng = random.Random(7)
    types = ["Couple", "Couples", "Family", "Families", "Solo traveler", "Group", "Group of friends",
             "Business traveller", "Business travellers", "Digital nomad", " ", None]
    rows = []
    for pid in "abcd":
        for kind in ("ALL", "BUSINESS_TRAVELLERS"):
            for n in range(rng.randrange(5, 60)):
                score = rng.choice(["Scored 8.4", "Scored 10", "Scored  7.5 ", "8.0", "Scored x", "Scored 6.1", None])
                date = rng.choice(["Stayed in May 2025", "Stayed in May 2024", "May", "2025", " ", None])
                rows.append(card(pid, kind, n, score, date, rng.choice(types)))
    rng.shuffle(rows)
    df = cards_df(spark, rows).repartition(5)
    same(as_dict(traveler_means_all_types(df, target, 3)), spec(rows, target, 3))
    fixed = {"all", "families", "couples", "solo_travelers", "business_travellers", "groups_friends"}
    want = {p: {k: v for k, v in r.items() if k in fixed} for p, r in spec(rows, target, 3).items()}
    same(as_dict(traveler_means(df, target, 3)), want)


def test_double_count_and_collision(spark):
    rows = [
        card("p", "ALL", 0, "Scored 8", "2025", "Couple"),
        card("p", "ALL", 1, "Scored 6", "2025", "Solo traveler"),
        card("p", "BUSINESS_TRAVELLERS", 0, "Scored 6", "2025", None),
        card("q", "ALL", 0, "Scored 10", "2025", "Family"),
        card("q", "ALL", 1, "Scored 4", "2025", "Families"),
        card("q", "ALL", 2, "Scored 6", "2025", "Families"),
    ]
    got = as_dict(traveler_means(cards_df(spark, rows), 2025))
    assert got["p"]["couples"] == (8.0, 1) and got["p"]["business_travellers"] == (6.0, 1)
    assert got["p"]["all"] == (pytest.approx(20 / 3), 3)
    assert got["q"]["families"] == (5.0, 2) and got["q"]["all"] == (pytest.approx(20 / 3), 3)
    parsed = V.parse_cards(cards_df(spark, rows))
    stats = V.type_stats(V.union_business(parsed), V.card_order(parsed))
    merged = {(r.property_id, r.traveler_type): (r.avg_score, r.n) for r in V.resolve_collisions(stats, merge=True).collect()}
    assert merged["q", "families"] == (pytest.approx(20 / 3), 3)


def test_year_filters_differ_on_unknown_dates(spark):
    rows = [
        card("p", kind, n, "Scored 5", date, "Couple")
        for kind in ("ALL", "BUSINESS_TRAVELLERS")
        for n, date in enumerate([None, "Stayed in May 2024", "May", "2025", " "])
    ]
    parsed = V.parse_cards(cards_df(spark, rows))
    kept = parsed.where(V.in_year(2025)).collect()
    assert sorted((r.list_kind, r.review_id) for r in kept) == [
        ("ALL", 0), ("ALL", 3), ("ALL", 4), ("BUSINESS_TRAVELLERS", 3),
    ]
    for target in (None, 0):
        assert parsed.where(V.in_year(target)).count() == 10


def test_unknown_type_matters_in_all_only(spark):
    rows = [card("p", k, 0, "Scored 5", "2025", None) for k in ("ALL", "BUSINESS_TRAVELLERS")]
    kept = V.parse_cards(cards_df(spark, rows)).where(V.known_type()).collect()
    assert [r.list_kind for r in kept] == ["BUSINESS_TRAVELLERS"]


def test_newest_k_of_a_hot_property(spark):
    """A third of all cards belong to one property; every cap and lane count gives the exact newest."""
    rng = random.Random(8)
    rows = []
    for n in range(1500):
        pid = "hot" if n % 3 == 0 else f"p{rng.randrange(200)}"
        ts = T0 + dt.timedelta(minutes=rng.randrange(400))  # many ties
        rows.append((pid, "ALL", ts, n, None, None, "Scored 5", None, None))
    df = cards_df(spark, rows).repartition(7)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append((-(r[2] - T0).total_seconds(), r[3]))
    for pages, size in ((2, 10), (1, 7), (20, 10), (500, 10), (None, 10), (0, 10)):
        got = V.newest_k(df, pages, size).collect()
        k = pages * size if pages else len(rows)
        want = {(p, i + 1, rid) for p, g in groups.items() for i, (_, rid) in enumerate(sorted(g)[:k])}
        assert {(r.property_id, r.seq, r.review_id) for r in got} == want


def test_newest_k_over_days_and_undated_cards(spark):
    """Cards without a time come last, in the order of their ids."""
    times = [T0 + dt.timedelta(days=n % 4, hours=n) for n in range(20)] + [None] * 5
    rows = [("p", "ALL", t, n, None, None, "Scored 5", None, None) for n, t in enumerate(times)]
    want = sorted(range(25), key=lambda n: (times[n] is None, -(times[n] - T0).total_seconds() if times[n] else 0, n))
    df = cards_df(spark, rows)
    assert [r.review_id for r in V.newest_k(df).orderBy("seq").collect()] == want
    assert [r.review_id for r in V.newest_k(df, 1, 7).orderBy("seq").collect()] == want[:7]


def test_a_list_without_dates_is_split(spark):
    """Undated cards, and cards of one day, are ranked in ranges of their order, not in one task."""
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # small ranges are put together otherwise
    spark.conf.set(small, "false")
    try:
        _list_without_dates(spark)
    finally:
        spark.conf.unset(small)


def _list_without_dates(spark):
    for times in ([None] * 3000, [T0 + dt.timedelta(seconds=n % 50) for n in range(3000)]):
        rows = [("p", "ALL", t, n, None, None, "Scored 5", None, None) for n, t in enumerate(times)]
        rows += [(None, "ALL", T0, 1, None, None, None, None, None), ("p", None, T0, 2, None, None, None, None, None)]
        df = cards_df(spark, rows).repartition(5)
        want = sorted(range(3000), key=lambda n: ((T0 - times[n]).total_seconds() if times[n] else 0, n))
        found = V.newest_k(df)
        assert [r.review_id for r in found.orderBy("seq").collect()] == want
        assert [r.seq for r in found.orderBy("seq").collect()] == list(range(1, 3001))
        stored_at = found.inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(stored_at).groupBy("lane").count().agg(F.max("count")).first()[0] < 2000


def test_nothing_is_capped_by_default(spark):
    """All 500 cards of each list enter the means; a cap has to be asked for."""
    rows = [card("p", k, n, f"Scored {n % 10}", "2025", "Couple") for k in ("ALL", "BUSINESS_TRAVELLERS") for n in range(500)]
    df = cards_df(spark, rows)
    bare = df.drop("page_no", "pos")
    for cards in (df, bare):
        (row,) = traveler_means(cards, 2025).collect()
        assert row.avg_review_score_all_count == 1000 and row.avg_review_score_couples_count == 500
        (row,) = traveler_means(cards, 2025, 20).collect()
        assert row.avg_review_score_all_count == 400
    assert V.first_pages(df).count() == V.capped(df, 0).count() == V.newest_k(df).count() == 1000
    same_pages = V.capped(bare, 20).select("review_id", "page_no", "pos").exceptAll(df.select("review_id", "page_no", "pos"))
    assert V.capped(bare, 20).count() == 400 and same_pages.count() == 0


@pytest.mark.parametrize("limit", [2, None])
def test_cards_without_page_numbers_give_the_same_means(spark, limit):
    rng = random.Random(11)
    rows = [
        card(p, k, n, f"Scored {rng.randrange(10, 100) / 10}", "2025", rng.choice(["Couple", "Couples", "Family"]))
        for p in "ab" for k in ("ALL", "BUSINESS_TRAVELLERS") for n in range(35)
    ]
    df = cards_df(spark, rows)
    assert as_dict(traveler_means(df, 2025, limit)) == as_dict(traveler_means(df.drop("page_no", "pos").repartition(6), 2025, limit))


def test_offered_lists(spark):
    rows = [card(p, k, 0, "Scored 5", "2025", "Couple") for p in "ab" for k in ("ALL", "BUSINESS_TRAVELLERS")]
    offered = spark.createDataFrame([("a", "BUSINESS_TRAVELLERS"), ("a", "BUSINESS_TRAVELLERS"), ("b", "ALL")], schemas.OFFERED_LISTS)
    got = {(r.property_id, r.list_kind) for r in V.offered_only(cards_df(spark, rows), offered).collect()}
    assert got == {("a", "ALL"), ("b", "ALL"), ("a", "BUSINESS_TRAVELLERS")}


def test_means_do_not_depend_on_partitions(spark):
    rng = random.Random(9)
    rows = [card("p", "ALL", n, f"Scored {rng.randrange(10, 101) / 10}", "2025", "Couple") for n in range(199)]
    means = {
        V.type_stats(V.parse_cards(cards_df(spark, rows).repartition(n))).first().avg_score for n in (1, 2, 3, 5, 7)
    }
    assert len(means) == 1


def test_scores_outside_the_exact_range_are_kept(spark):
    rows = [card("p", "ALL", n, f"Scored {s}", "2025", "Couple") for n, s in enumerate(["123456789012345", "0.123456789012", "1"])]
    row = V.type_stats(V.parse_cards(cards_df(spark, rows))).first()
    assert row.n == 3
    assert row.avg_score == pytest.approx((123456789012345 + 0.123456789012 + 1) / 3, rel=1e-15)


def test_cards_from_review_pages(spark):
    html = (
        '<div data-testid="review-card"><div><div>Scored 8.0</div></div><span data-testid="review-stay-date"> May 2025 </span>'
        '<span data-testid="review-traveler-type">Couple</span></div>'
        '<div data-testid="review-card"><div>no score</div></div>'
        '<div data-testid="review-card"><div>Scored 7</div><span data-testid="review-traveler-type">Family</span></div>'
    )
    df = spark.createDataFrame([("p", "ALL", 1, html)], schemas.REVIEW_PAGES)
    got = [tuple(r) for r in V.cards_from_pages(df).orderBy("pos").collect()]
    assert got == [
        ("p", "ALL", 1, 1, "Scored 8.0", " May 2025 ", "Couple"),
        ("p", "ALL", 1, 2, None, None, None),
        ("p", "ALL", 1, 3, "Scored 7", None, "Family"),
    ]


def test_counts_and_means_are_consistent(spark):
    """Without collisions type counts add up to the total and so do weighted means."""
    rng = random.Random(10)
    kinds = ["Couple", "Family", "Solo traveler", "Group"]
    rows = [
        card(p, "ALL", n, f"Scored {rng.randrange(10, 101) / 10}", "2025", rng.choice(kinds)) for p in "abc" for n in range(50)
    ] + [card(p, "BUSINESS_TRAVELLERS", n, "Scored 7.7", "2025", None) for p in "ab" for n in range(9)]
    for row in as_dict(traveler_means(cards_df(spark, rows), 2025)).values():
        mean, count = row.pop("all")
        assert count == sum(n for _, n in row.values())
        assert mean == pytest.approx(sum(m * n for m, n in row.values()) / count, abs=1e-9)


def test_known_types_are_not_confused_with_columns(spark):
    rows = [card("p", "ALL", 0, "Scored 5", "2025", "My.type (x)"), card("p", "ALL", 1, "Scored 7", "2025", "All")]
    got = traveler_means_all_types(cards_df(spark, rows), 2025)
    assert "avg_review_score_my.type_(x)" in got.columns
    assert got.select(F.col("`avg_review_score_my.type_(x)`")).first()[0] == 5.0
    assert len(set(got.columns)) == len(got.columns)
    assert got.first().avg_review_score_all == 6.0
