"""Every query that has SQL gives what the SQL gives on the smallest test tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from ledgerline.plans import core_queries, evidence_queries

FOLDER = Path(os.environ.get("LEDGERLINE_TESTDATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
QUERIES = {**evidence_queries.QUERIES, **core_queries.QUERIES}
SQL = {**evidence_queries.SQL, **core_queries.SQL}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for p in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def text(v):
    return "NULL" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v).replace("+00:00", "")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    expected = duck.sql(SQL[name])
    assert sorted(expected.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall()
    assert sorted(tuple(map(text, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(text, r)) for r in want)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_without_sql(spark, name):
    df = QUERIES[name](spark, str(FOLDER))
    assert df.count() > 0 and all(t != "void" for _, t in df.dtypes)
