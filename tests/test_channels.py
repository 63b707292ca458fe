"""Error channel, exported runs, totals of several groupings, types as maps, run keys, first N by ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.functions.markup import select_elements
from staylens.functions.rules import Rule
from staylens.operators import errors, links, runs
from staylens.operators import reviews as V
from staylens.sinks.exports import export_run
from staylens.sources.exports import read_runs


def test_channel_loses_no_row(spark):
    rows = [(1, "Scored 8.1", "2024"), (2, "Scored x", " "), (3, None, "20 24"), (4, "", None), (5, "Scored 7", "in 2025")]
    cards = spark.createDataFrame(rows, "id int, score string, day string")
    read = errors.channel(
        cards,
        ["id"],
        {
            "value": errors.Reading(F.col("score"), V.parse_score(F.col("score")), required=True),
            "year": errors.Reading(F.col("day"), F.regexp_extract("day", "(20[0-9]{2})", 1).try_cast("int")),
        },
    )
    told = {r.id: (r.value, r.year, r.reason, r.input) for r in read.collect()}
    assert told == {
        1: (8.1, 2024, None, None),
        2: (None, None, "unreadable value", "Scored x"),
        3: (None, None, "missing value, unreadable year", "20 24"),
        4: (None, None, "missing value", None),
        5: (7.0, 2025, None, None),
    }
    assert errors.channel_counts(read).first().asDict() == {"n_input": 5, "n_good": 2, "n_bad": 3}
    assert errors.good(read).columns == ["id", "value", "year"] and errors.bad(read).count() == 3
    assert errors.channel_counts(read.limit(0)).first().asDict() == {"n_input": 0, "n_good": 0, "n_bad": 0}


def test_pages_that_cannot_be_read_have_a_reason(spark):
    pages = spark.createDataFrame([(1, None), (2, " \n"), (3, "<a>x</a>"), (4, "text")], "page_id int, html string")
    found = F.when(F.col("page_id") != 4, select_elements(F.col("html"), [Rule("a", "a")]))
    told = {r.page_id: r.reason for r in errors.page_channel(pages, found).collect()}
    assert told == {1: "missing page", 2: "blank page", 3: None, 4: "unreadable page"}


def test_broken_lines_of_files(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    (tmp_path / "a.csv").write_text("1,x\ny,z\n2,w\n")
    read = errors.csv_channel(spark, str(tmp_path / "a.csv"), schema)
    assert sorted((r.id or 0, r.reason, r.input) for r in read.collect()) == [(0, "unreadable line", "y,z"), (1, None, None), (2, None, None)]
    assert errors.channel_counts(read).first().n_bad == 1
    (tmp_path / "b.json").write_text('{"id": 1, "name": "x"}\n{"id": \n{"id": "q"}\n')
    read = errors.json_channel(spark, str(tmp_path / "b.json"), schema)
    assert sorted(r.reason or "" for r in read.collect()) == ["", "unreadable line", "unreadable line"]
    assert {r.file.rsplit("/", 1)[1] for r in read.collect()} == {"b.json"}


def record(spark, rows, extra=()):
    fields = [f for f in schemas.RECORD_15 if f.name in ("property_id", "category", "general_review")]
    return spark.createDataFrame(rows, T.StructType([*fields, *(T.StructField(n, T.DoubleType()) for n in extra)]))


def test_runs_with_other_columns_come_back_by_name(spark, tmp_path):
    at = str(tmp_path / "runs")
    export_run(record(spark, [("a", "Inn", 8.5), ("b", None, None)]), at, "one")
    export_run(record(spark, [("c", 'x "y", z', 7.0, 9.5)], ["avg_review_score_pilgrims"]), at, "two")
    export_run(record(spark, [("d", "é", 6.0, 1.0)], ["avg_review_score_art"]), at, "three")
    for _ in range(2):  # a run that is exported again replaces itself
        export_run(record(spark, [("e", "Inn", 1.0, 2.0)], ["avg_review_score_pilgrims"]), at, "four")
    back = read_runs(spark, at, schemas.RECORD_15)
    assert back.columns == ["run", *schemas.RECORD_15.names, "avg_review_score_art", "avg_review_score_pilgrims"]
    got = {r.property_id: (r.run, r.category, r.general_review, r.avg_review_score_art, r.avg_review_score_pilgrims, r.wifi_speed) for r in back.collect()}
    assert got == {
        "a": ("one", "Inn", 8.5, None, None, None),
        "b": ("one", None, None, None, None, None),
        "c": ("two", 'x "y", z', 7.0, None, 9.5, None),
        "d": ("three", "é", 6.0, 1.0, None, None),
        "e": ("four", "Inn", 1.0, None, 2.0, None),
    }
    with pytest.raises(ValueError, match="no exported"):
        (tmp_path / "none").mkdir()
        read_runs(spark, str(tmp_path / "none"), schemas.RECORD_15)


def stats(spark, n_types, properties=3):
    rows = spark.range(n_types * properties).select(
        F.concat(F.lit("p"), F.col("id") % properties).alias("property_id"),
        F.concat(F.lit("type "), F.floor(F.col("id") / properties)).alias("traveler_type"),
        (F.col("id") % 10).cast("double").alias("score"),
    )
    return V.type_stats(rows, F.lit(1))


def test_fifty_thousand_types_in_maps(spark):
    maps = V.type_map(V.resolve_collisions(stats(spark, 50_000)))
    assert [r.n for r in maps.select(F.size("types").alias("n")).collect()] == [50_000] * 3
    wide = V.from_type_map(maps, ["type_7", "absent"])
    row = wide.where("property_id = 'p1'").first()
    assert row.avg_review_score_type_7 == 2.0 and row.avg_review_score_type_7_count == 1 and row.avg_review_score_absent is None
    assert wide.select(F.size("other_types")).first()[0] == 49_999
    assert "pivot" not in wide._jdf.queryExecution().toString().lower()


def test_totals_of_all_levels(spark):
    rows = V.rolled_up(stats(spark, 4), "property_id", "traveler_type").collect()
    by_level = {k: sum(r.n for r in rows if r.level == k) for k in (0, 1, 3)}
    assert by_level == {0: 12, 1: 12, 3: 12} and len(rows) == 12 + 3 + 1
    plan = V.rolled_up(stats(spark, 4), "property_id", "traveler_type")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "Union" not in plan
    assert V.grouped_totals(stats(spark, 4), [["traveler_type"], []]).count() == 5


def test_run_keys_follow_order_and_cities(spark):
    def key(cities):
        rows = [(1, i, c, "2025-01-02 03:04:05") for i, c in enumerate(cities)]
        random.Random(len(cities)).shuffle(rows)
        df = spark.createDataFrame(rows, "run int, dest_seq int, city string, started string").withColumn("started", F.col("started").cast("timestamp"))
        return runs.run_keys(df.repartition(3), ["run"])

    one = key(["Fes", "Tangier", "Rabat"]).first()
    assert (one.n_cities, one.first_city, one.last_city) == (3, "Fes", "Rabat")
    assert one.run_id.startswith("fes-rabat_") and one.run_id.endswith("_20250102_030405")
    assert key(["Fes", "Tangier", "Rabat"]).first().digest == one.digest != key(["Tangier", "Fes", "Rabat"]).first().digest
    plan = key([f"c{i}" for i in range(500)])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("limit", [0, 1, 777, 3000, 5000])
def test_first_n_by_ranges(spark, limit):
    rows = spark.range(3000).select(
        (F.col("id") * 7919 % 13).cast("int").alias("dest_seq"), (F.col("id") * 31 % 11).cast("int").alias("scroll_no"), F.col("id").cast("int").alias("pos"), F.lit("h").alias("href")
    )
    got = {(r.dest_seq, r.scroll_no, r.pos) for r in links.first_n_split(rows, limit).collect()}
    assert got == {(r.dest_seq, r.scroll_no, r.pos) for r in rows.orderBy("dest_seq", "scroll_no", "pos").limit(limit).collect()}


def test_no_task_holds_ten_million_rows(spark):
    plan = links.first_n_split(spark.range(100).selectExpr("0 dest_seq", "0 scroll_no", "id pos", "'h' href"), 10_000_000)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in shown and "GlobalLimit" not in shown and "SinglePartition" not in shown and plan.count() == 100
