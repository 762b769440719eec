"""The queries that SQL can express, on the smallest tables, and that all names are registered."""

import re

import duckdb
import pytest

import corpus_pipeline
from fleetspan import llm

SF_DIR = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__ as entry

    numbers = [int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == [*range(1, 14)]
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(name, spark):
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents", "labels", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = llm.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = con.execute(llm.oracle_sql()[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == columns
    expected = sorted(repr(tuple(r[order.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected
