"""Every registered query against its SQL twin on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from fleetspan.plans import load_all

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def test_every_query_has_a_twin():
    assert set(load_all()) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_flagship_runs(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_equals_sql(name, spark, duck):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = duck.execute(entry_point.oracle_sql()[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == columns
    expected = [tuple(plain(r[order.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))
