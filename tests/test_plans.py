"""Plans: no product of tables anywhere, scans read the columns that are needed, filters reach the scan."""

import os
import re
from pathlib import Path

import pytest

from ledgerline.plans import core_queries, evidence_queries

FOLDER = Path(os.environ.get("LEDGERLINE_TESTDATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
QUERIES = {**evidence_queries.QUERIES, **core_queries.QUERIES}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products(spark, name):
    text = plan(QUERIES[name](spark, str(FOLDER)))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


def schemas(text, table):
    return re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<(.*?)>(?:\n|$)", text)


def test_columns_are_pruned(spark, monkeypatch):
    from ledgerline.operators import history

    monkeypatch.setattr(history, "cut", lambda df: df)  # what is stored has its scan behind it
    read = schemas(plan(QUERIES["p3_found"](spark, str(FOLDER))), "github_repo_snapshots")
    assert read and all(r == "repo_url:string,stargazers_count:int,stars_fetched_at:timestamp,api_status:string" for r in read)
    read = schemas(plan(QUERIES["lineage"](spark, str(FOLDER))), "fetch_observations")
    assert read and not any("raw_payload" in r for r in read)
    read = schemas(plan(QUERIES["p1_entries"](spark, str(FOLDER))), "fetch_observations")
    assert read == ["id:string,raw_payload:struct<atom_xml:string>"] or all("html" not in r for r in read)


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["first_by_status"](spark, str(FOLDER)))
    assert "EqualTo(status,RESOLVED)" in text and "TakeOrderedAndProject" in text
    assert "WindowGroupLimit" in plan(QUERIES["latest_snapshot"](spark, str(FOLDER)))
