"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_module
from staylens.plans.oracles import ORACLES
from staylens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_module.queries().items() and ORACLES.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = [dict(zip(columns, row)) for row in result.fetchall()]
    assert sorted(df.columns) == sorted(columns)

    def key(row):
        return tuple(repr(row[c]) for c in sorted(columns))

    assert sorted(key(r.asDict()) for r in df.collect()) == sorted(map(key, want))


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "property_id" and len(df.columns) == 31 and df.count() > 0


def test_newest_first_is_sorted(spark):
    rows = QUERIES["newest_first"](spark, SF).collect()
    order = [(-(r.review_ts - dt.datetime(2000, 1, 1)).total_seconds(), r.review_id) for r in rows]
    assert order == sorted(order)
