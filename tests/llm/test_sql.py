"""The queries that have SQL against DuckDB, on whole tables, and all names."""

import os

import pytest

import __spark_entry__ as entry
from cohort_engine.llm.queries import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no test data at {FOLDER}")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    assert sorted(con.sql(ORACLE[name]).columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = con.sql(f"SELECT {listed} FROM ({ORACLE[name]}) AS q").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(expected)
    assert expected


def test_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(entry.oracle_sql())
