from __future__ import annotations

import contextlib
import io
import json
import random
import re

from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators import location as L

NON_LATIN = r"[^a-zA-Z0-9\s\-,\.']"
ZONE = ("neighbourhood", "suburb", "quarter", "city_district", "district")


def test_address_order_of_steps(evaluate):
    values = ["Café, Rue 1", ", a ,", "日本", None, "O'Neil-St. 5"]
    assert evaluate(values, L.clean_address) == ["Caf  Rue 1", "  a  ", "", None, "O'Neil-St. 5"]


def spec_zone(address):
    """First text left after cleaning; '' if all given texts vanish; None if none is given."""
    cleaned = [re.sub(NON_LATIN, "", address[f]).strip() for f in ZONE if address.get(f)]
    return next(filter(None, cleaned), "" if cleaned else None)


def test_zone_and_city(spark):
    rows = [
        {"neighbourhood": "日本", "suburb": "X"},
        {"neighbourhood": "日本"},
        {"town": " Gueznaïa "},
        {"city": "", "town": "T", "village": "V"},
        {},
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a map<string,string>")
    got = df.select("i", L.pick_zone(F.col("a")).alias("z"), L.pick_city(F.col("a")).alias("c")).orderBy("i").collect()
    assert [(r.z, r.c) for r in got] == [("X", None), ("", None), (None, "Gueznaïa"), (None, "T"), (None, None)]


def test_zone_on_random_maps(spark):
    rng = random.Random(6)
    rows = [
        {f: rng.choice(["", "日", " é ", "A b", "c,d"]) for f in ZONE if rng.random() < 0.6} for _ in range(200)
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a map<string,string>")
    got = [r.z for r in df.select("i", L.pick_zone(F.col("a")).alias("z")).orderBy("i").collect()]
    assert got == [spec_zone(r) for r in rows]


def test_lookup_keeps_rows_and_never_multiplies(spark):
    body = json.dumps({"display_name": "Rue 1, Tétouan", "address": {"suburb": "S", "city": "Tétouan"}})
    geocodes = spark.createDataFrame(
        [(35.5, -5.5, body), (35.5, -5.5, body + " "), (1.0, 1.0, "{broken"), (2.0, 2.0, "{}")], schemas.GEOCODES
    )
    rows = [("a", 35.5, -5.5), ("b", None, None), ("c", 9.0, 9.0), ("d", 1.0, 1.0), ("e", 2.0, 2.0), ("f", None, -5.5)]
    df = spark.createDataFrame(rows, "property_id string, latitude double, longitude double")
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = L.locate(df, L.locations(geocodes), "property_id").orderBy("property_id").collect()
        assert [(r.address, r.zone, r.city) for r in got] == [
            ("Rue 1  Ttouan", "S", "Tétouan"), (None, None, None), (None, None, None),
            (None, None, None), ("", None, None), (None, None, None),
        ]
        assert got[0].latitude == 35.5 and got[1].latitude is None
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_coordinates_are_spread(spark):
    geocodes = spark.createDataFrame([(1.0, 1.0, "{}")], schemas.GEOCODES)
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("property_id"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = L.locate(df, L.locations(geocodes), "property_id").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_hot_point_is_split(spark):
    """Without a broadcast, a point with a third of all properties goes to several tasks."""
    hot = F.col("id") % 3 == 0
    df = spark.range(0, 120_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("property_id"),
        F.when(hot, 31.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)) + 100.5).alias("latitude"),
        F.lit(2.5).alias("longitude"),
    )
    rows = [(100.5 + n, 2.5, '{"address":{"city":"c"}}') for n in range(500)] + [(31.5, 2.5, '{"address":{"city":"h"}}')]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        placed = L.locate(df, L.locations(spark.createDataFrame(rows, schemas.GEOCODES)), "property_id")
        counts = placed.groupBy("city").agg(F.count("*").alias("count"), F.max("property_id"))
        assert {r.city: r["count"] for r in counts.collect()} == {"h": 40_000, "c": 80_000}
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            counts.explain()
        assert "skew=true" in text.getvalue()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_failed_response_does_not_hide_a_good_one(spark):
    good = '{"display_name":"A, B","address":{"city":"X"}}'
    rows = [(1.0, 1.0, "!{"), (1.0, 1.0, good), (2.0, 2.0, ""), (2.0, 2.0, good), (3.0, 3.0, None), (3.0, 3.0, "broken")]
    found = L.locations(spark.createDataFrame(rows, schemas.GEOCODES)).orderBy("lat").collect()
    assert [(r.lat, r.address, r.city) for r in found] == [(1.0, "A  B", "X"), (2.0, "A  B", "X"), (3.0, None, None)]


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from staylens.functions.workspace import scratch_dir

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077"), "x")
    assert scratch_dir(session("local[4]"), "x")
