"""The queries over the smallest test tables: columns, rows, plans."""

import os
import re
from pathlib import Path

import pytest

from ledgerline.llm.queries import QUERIES, SQL

FOLDER = Path(os.environ.get("LEDGERLINE_TESTDATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
FOUND = {"p2_found": [("id", "string"), ("block_no", "bigint")], "p5_found": [("name_a", "string"), ("name_b", "string")], "p8_found": [("doc_id", "bigint"), ("band", "string")]}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(FOLDER))
    if name in FOUND:
        assert df.dtypes == FOUND[name]
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", df._jdf.queryExecution().executedPlan().toString())
    rows = df.collect()
    assert rows and (name not in FOUND or len(set(rows)) == len(rows))


def test_long_documents_have_bands_and_all_have_places(spark):
    documents = spark.read.parquet(str(FOLDER / "documents.parquet"))
    long = sum(len((r.text or "").split()) >= 40 for r in documents.select("text").collect())
    assert QUERIES["p8_found"](spark, str(FOLDER)).count() == long
    packed = QUERIES["p6_pack"](spark, str(FOLDER))
    assert {r["count"] for r in packed.select("container", "doc_id").distinct().groupBy("container").count().collect()} == {documents.count()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for p in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    want = con.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({SQL[name]})").fetchall()
    assert sorted(tuple(map(text, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(text, r)) for r in want)
