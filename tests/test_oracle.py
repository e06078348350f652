"""Every query with an SQL counterpart against DuckDB, on whole tables."""

import datetime as dt
import os

import pytest

import __spark_entry__ as entry
from verification.oracle import ORACLE
from verification.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("customer", "lineitem", "nation", "orders", "part", "region", "supplier")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no test data at {FOLDER}")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    sql = ORACLE[name]
    expected = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({sql}) AS q")
    assert sorted(duck.sql(sql).columns) == columns
    rows = ordered(expected.fetchall())
    assert ordered(df.select(*columns).collect()) == rows
    assert rows, "the query finds nothing, so it proves nothing"


def test_each_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(ORACLE) == {"risk_scores", "tune_results"}


def test_known_answers(spark):
    queries = entry.queries()
    labels = {r.label: r["count"] for r in queries["label_distribution"](spark, FOLDER).collect()}
    assert labels[1] > 0 and sum(labels.values()) == 40457
    cells = queries["contingency"](spark, FOLDER).collect()
    assert sorted(r.patients for r in cells) == [237, 340, 364, 559]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert not any(isinstance(v, dt.datetime) for v in df.first())
