from __future__ import annotations

import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import record as R
from staylens.operators import runs
from staylens.plans import jobs
from staylens.plans.records import base_records, review_records, short_records
from staylens.sinks import exports as out
from staylens.sources import exports as src
from staylens.sources import tables

TS = "2025-09-10 15:31:07"
BODY = '{"display_name": "Rue 1, Tanger", "address": {"suburb": "S", "city": "Tangier"}}'
SCORED = """<div id="js--hp-gallery-scorecard"><a><div><div><div><div>Good</div><div>8.4</div></div></div></div></a></div>
<div data-testid="review-card"></div>"""


def inputs(spark):
    pages = spark.createDataFrame(
        [
            (1, "/hotel/a?x=1", SCORED + '"latitude":35.5,"longitude":-5.0005 € 50'),
            (2, "/hotel/b", SCORED + '<span data-testid="breadcrumb-current"><span>Inn, "old"</span></span>'),
            (3, "/hotel/c", SCORED.split("<div data")[0]),
        ],
        schemas.PAGES,
    )
    geocodes = spark.createDataFrame([(35.5, -5.0005, BODY)], schemas.GEOCODES)
    key = {r.page_id: r.property_id for r in R.stamped(pages, TS).collect()}
    cards = spark.createDataFrame(
        [
            (key[1], "ALL", None, 1, 1, 1, "Scored 8", "2025", "Couple"),
            (key[1], "ALL", None, 2, 1, 2, "Scored 9", "2025", "Digital nomad"),
            (key[2], "ALL", None, 3, 1, 1, "Scored 5", "2024", "Couple"),
            (key[3], "ALL", None, 4, 1, 1, "Scored 5", "2025", "Couple"),
        ],
        schemas.REVIEW_CARDS,
    )
    return pages, geocodes, cards


def fields(schema):
    return [(f.name, f.dataType) for f in schema]


def test_column_contracts():
    assert len(schemas.RECORD_15) == 15 and len(schemas.RECORD_31) == 31
    assert schemas.RECORD_15.names[:3] == ["property_id", "scrape_timestamp", "property_url"]
    assert schemas.RECORD_31.names[-1] == schemas.RECORD_15.names[-1] == "wifi_speed"
    assert set(schemas.RECORD_15.names) < set(schemas.RECORD_31.names)


def test_short_record(spark):
    pages, geocodes, _ = inputs(spark)
    df = short_records(base_records(pages, TS), geocodes)
    assert fields(df.schema) == fields(schemas.RECORD_15)
    rows = {r.property_url: r for r in df.collect()}
    a = rows["/hotel/a?x=1"]
    assert (a.min_price, a.latitude, a.address, a.zone, a.city) == (50, 35.5, "Rue 1  Tanger", "S", "Tangier")
    assert a.scrape_timestamp == dt.datetime(2025, 9, 10, 15, 31, 7)
    # the short form shows the score without the review gate
    assert rows["/hotel/c"].general_review == 8.4


def test_review_record_and_gate(spark):
    pages, geocodes, cards = inputs(spark)
    df = review_records(base_records(pages, TS), geocodes, cards, 2025)
    assert df.columns == schemas.RECORD_31.names
    rows = {r.property_url: r for r in df.collect()}
    a, b, c = rows["/hotel/a?x=1"], rows["/hotel/b"], rows["/hotel/c"]
    assert (a.avg_review_score_all, a.avg_review_score_all_count, a.avg_review_score_couples) == (8.5, 2, 8.0)
    assert (b.general_review, b.avg_review_score_all, b.filtered_year) == (8.4, None, 2025)
    assert c.general_review is None and c.avg_review_score_all is None  # its page shows no review card
    wide = review_records(base_records(pages, TS), geocodes, cards, None, all_types=True)
    assert wide.columns[31:] == ["avg_review_score_digital_nomad", "avg_review_score_digital_nomad_count"]
    assert wide.where("filtered_year is null").count() == 3


def test_keys_are_stable_and_unique(spark):
    df = spark.createDataFrame([(1, "h/a?x"), (2, "h/a?y"), (3, "h/b")], "page_id int, url string")
    ids = [r.property_id for r in R.stamped(df, TS).orderBy("page_id").collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64
    assert df.select(R.random_id().alias("u")).distinct().count() == 3


def test_csv_round_trip(spark, tmp_path):
    pages, geocodes, cards = inputs(spark)
    df = review_records(base_records(pages, TS), geocodes, cards, 2025)
    path = str(tmp_path / "csv")
    out.append_csv(df, path)
    out.append_csv(df, path)
    assert src.header(spark, path) == schemas.RECORD_31.names
    rows = []
    for name in glob.glob(path + "/*.csv"):
        with open(name, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    assert len(rows) == 6
    a = next(r for r in rows if r["property_url"] == "/hotel/a?x=1")
    b = next(r for r in rows if r["property_url"] == "/hotel/b")
    assert (a["longitude"], a["min_price"], a["avg_review_score_all"], a["comfort_score"]) == ("-5.0005", "50", "8.5", "0")
    assert (a["scrape_timestamp"], a["category"], b["latitude"], b["min_price"]) == (TS, "", "", "0")
    assert b["category"] == 'Inn, "old"'
    back = src.read_export(spark, path, schemas.RECORD_31)
    assert fields(back.schema) == fields(schemas.RECORD_31)
    assert back.distinct().exceptAll(df).count() == 0 and back.count() == 6


def test_spaces_survive_the_csv(spark, tmp_path):
    df = R.record_15(spark.createDataFrame([("k", "  a  b ")], "property_id string, address string"))
    out.export_csv(df, str(tmp_path / "c"))
    assert src.read_export(spark, str(tmp_path / "c"), schemas.RECORD_15).first().address == "  a  b "


def test_batch_with_new_columns_does_not_break_the_file(spark, tmp_path):
    pages, geocodes, cards = inputs(spark)
    base = base_records(pages, TS)
    plain = review_records(base, geocodes, cards, 2025)
    wide = review_records(base, geocodes, cards, 2025, all_types=True)
    path = str(tmp_path / "csv")
    out.append_csv(plain, path)
    with pytest.raises(ValueError, match="digital_nomad"):
        out.append_csv(wide, path)
    # the record table takes both; a fresh export has one header for all
    table = str(tmp_path / "records")
    out.write_records(plain, table, "r1")
    out.write_records(wide, table, "r2")
    out.write_records(wide, table, "r2")  # a repeated run replaces itself
    every = out.read_records(spark, table)
    assert every.count() == 6
    assert every.where("run_id = 'r1' and avg_review_score_digital_nomad is not null").count() == 0
    out.export_csv(every.drop("run_id"), str(tmp_path / "all"))
    back = src.read_export(spark, str(tmp_path / "all"), schemas.RECORD_31)
    assert dict(back.dtypes)["avg_review_score_digital_nomad_count"] == "bigint"
    assert back.where("avg_review_score_digital_nomad = 9.0").count() == 1
    out.append_csv(plain, str(tmp_path / "all"))
    assert src.read_export(spark, str(tmp_path / "all"), schemas.RECORD_31).count() == 9


def test_run_name_and_progress(spark):
    rows = [(1, 1, "Marrakech"), (1, 2, "El Jadida"), (2, 1, "Tangier")]
    df = spark.createDataFrame(rows, "run int, dest_seq int, city string").withColumn(
        "started", F.lit("2026-01-05 08:00:00").cast("timestamp")
    )
    got = [r.run_id for r in runs.run_names(df, ["run"]).orderBy("run").collect()]
    assert got == ["marrakech-el jadida_20260105_080000", "tangier_20260105_080000"]
    row = runs.run_summary(df, "run", F.col("city") == "Marrakech").orderBy("run").first()
    assert (row.n_done, row.n_total, row.percent) == (1, 2, 50.0)
    seen = Observation("rows")
    runs.observed(df.withColumn("property_url", F.col("city")), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 3, "n_without_url": 0}


def test_rejected_rows_carry_reasons(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", 1.0)], "i int, category string, latitude double")
    got = {r.i: r.reason for r in runs.rejected(df, ("category", "latitude"), ("i",)).collect()}
    assert got == {1: "missing latitude", 2: "missing category, latitude"}


def test_page_heads(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é" * 12000)], schemas.PAGES)
    out.write_page_heads(pages, str(tmp_path / "h"))
    out.write_page_heads(pages, str(tmp_path / "h"))
    rows = spark.read.parquet(str(tmp_path / "h")).collect()
    assert [len(r["head"]) for r in rows] == [10000]


def test_job_end_to_end(spark, tmp_path):
    pages, geocodes, cards = inputs(spark)
    link = '<a data-testid="title-link" href="/hotel/{}">t</a>'
    views = spark.createDataFrame([(0, 1, link.format("a?from=search") + link.format("b"))], schemas.SEARCH_VIEWS)
    paths = {}
    for name, df in {"pages": pages, "geocodes": geocodes, "cards": cards, "views": views}.items():
        paths[name] = str(tmp_path / name)
        df.write.parquet(paths[name])
    done = jobs.run(
        spark, "reviews", str(tmp_path / "out"), run_id="r", run_ts=TS, year=2025, csv=str(tmp_path / "csv"), **paths
    )
    assert {r.property_url for r in done.collect()} == {"/hotel/a?from=search", "/hotel/b"}
    assert src.read_export(spark, str(tmp_path / "csv"), schemas.RECORD_31).count() == 2
    paths.pop("cards"), paths.pop("views")
    assert jobs.run(spark, "short", str(tmp_path / "out2"), run_id="r", run_ts=TS, **paths).count() == 3


def test_views_for_sql(spark):
    pages, _, _ = inputs(spark)
    tables.register_views(spark, stored_pages=pages)
    assert spark.sql("select count(*) from stored_pages").first()[0] == 3
