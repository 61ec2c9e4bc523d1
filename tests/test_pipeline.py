import pytest
from pyspark.sql import functions as F

from ledgerline.operators.relational import ordered_candidates, selected_links
from ledgerline.plans.pipeline import Pipeline, Settings
from ledgerline.plans.run import Environment, make_pipeline
from ledgerline.schemas import key_violations, with_defaults
from ledgerline.sources.replay import SNAPSHOT, replay_pages
from ledgerline.tables import SnapshotStore

FEED = '<feed xmlns="http://www.w3.org/2005/Atom">{}</feed>'
ENTRY = "<entry><id>http://h/abs/{0}v1</id><title>{1}</title><summary>s</summary><published>2025-01-02T03:04:05Z</published><author><name>Ann</name></author></entry>"
PAGE = '<td class="tablecell comments">{}</td>'
LINK = '<a href="https://github.com/{}">code</a>'


def test_a_whole_run_and_its_repetition(spark, tmp_path):
    base = "http://feed/query"
    url = lambda start: f"{base}?search_query=cat%3Acs.AI&start={start}&max_results=2&sortBy=submittedDate&sortOrder=descending"
    recorded = [
        (url(0), 1, 500, None),
        (url(0), 2, 200, FEED.format(ENTRY.format("1", "One") + ENTRY.format("2", " "))),
        (url(2), 1, 200, FEED.format(ENTRY.format("3", "Three") + "<entry><title>x</title></entry>")),
        (url(4), 1, 200, FEED.format("")),
        (url(6), 1, 200, FEED.format(ENTRY.format("9", "Past the end"))),
        ("https://arxiv.org/abs/1", 1, 200, PAGE.format(LINK.format("a/b") + LINK.format("a/b/tree/x"))),
        ("https://arxiv.org/abs/2", 1, 404, None),
        ("https://arxiv.org/abs/3", 1, 200, PAGE.format(LINK.format("a/b") + LINK.format("c/d"))),
    ]
    log = spark.createDataFrame(recorded, "url string, attempt int, http_status int, body string")
    calls = []

    def look_up(repos):
        calls.extend(r.repo_url for r in repos.collect())
        return repos.select("repo_url", F.lit(True).alias("exists_verified"), F.lit(5).alias("stargazers_count"), F.lit("2025-03-01").cast("timestamp").alias("stars_fetched_at"), F.lit("OK").alias("api_status")).select(*(c.split()[0] for c in SNAPSHOT.split(", ")))

    store = SnapshotStore(spark, str(tmp_path / "store"))
    make = lambda n: Pipeline(store, Settings(f"run{n}", f"2025-03-0{n} 00:00:00", base, page_size=2, max_results=8, sheet_path=str(tmp_path), sheet_id="s"), lambda urls: replay_pages(urls, log), look_up)
    make(1).run()
    papers = {r.arxiv_id: r for r in store.read("papers").collect()}
    assert {k: (r.status, r.failure_reason) for k, r in papers.items()} == {"1": ("VALIDATED", None), "2": ("FAILED", "empty title"), "3": ("VALIDATED", None)}
    assert calls == ["https://github.com/a/b"]
    sheet = {r.title: r for r in spark.read.option("header", True).csv(str(tmp_path / "s")).collect()}
    assert (sheet["One"].github_url, sheet["One"].github_stars) == ("https://github.com/a/b", "5") and sheet["Three"].github_url is None
    links = {(r.repo_url, r.is_selected) for r in store.read("paper_repo_links").where(F.col("paper_id") == papers["1"].id).collect()}
    assert links == {("https://github.com/a/b", True)} and store.read("paper_repo_links").count() == 3
    kinds = {r.fetch_status: r["count"] for r in store.read("fetch_observations").groupBy("fetch_status").count().collect()}
    assert kinds == {"OK": 5, "ERROR": 1}
    assert store.read("validated_records").where("exported_at IS NULL").count() == 0
    assert store.read("pipeline_log").where("stage = 'discovery_reject'").count() == 1
    told = {(r.status, r.error_type): r["count"] for r in store.read("pipeline_log").where("stage = 'validate'").groupBy("status", "error_type").count().collect()}
    assert told == {("OK", None): 2, ("FAILED", "PaperValidationError"): 1}
    assert store.read("fetch_observations").where("source_url LIKE '%search_query%'").count() == 0

    # The same run again changes nothing but the log; a later run sees the papers again and adds observations.
    make(1).run()
    assert store.read("papers").count() == 3 and store.read("fetch_observations").count() == 6 and len(calls) == 1
    make(2).run()
    again = {r.arxiv_id: r for r in store.read("papers").collect()}
    assert {k: (r.id, r.status, r.first_seen_at) for k, r in again.items()} == {k: (r.id, r.status, r.first_seen_at) for k, r in papers.items()}
    assert all(again[k].last_seen_at > papers[k].last_seen_at for k in papers)
    assert store.read("fetch_observations").count() == 9 and store.read("paper_fetch_observations").count() == 6


def test_a_run_from_the_environment(spark, tmp_path):
    env = Environment.read({"DATABASE_URL": str(tmp_path / "s"), "ARXIV_PAGE_SIZE": "7", "GITHUB_TOKEN": ""}, file=str(tmp_path / "none"))
    assert env.arxiv_page_size == 7 and env.github_token is None and env.max_retry_attempts == 5
    (tmp_path / "env").write_text("# x\nDATABASE_URL='d'\nARXIV_MAX_RESULTS=9\n")
    env = Environment.read({"ARXIV_MAX_RESULTS": "8"}, file=str(tmp_path / "env"))
    assert (env.database_url, env.arxiv_max_results) == ("d", 8)
    for bad in ({}, {"DATABASE_URL": "d", "ARXIV_PAGE_SIZE": "x"}):
        with pytest.raises(ValueError):
            Environment.read(bad, file=str(tmp_path / "none"))
    made = make_pipeline(spark, env, "r", "2025-01-01 00:00:00")
    assert made.settings.feed_query == "cat:cs.AI" and made.settings.page_size == 100


def test_keys_and_defaults(spark):
    papers = spark.createDataFrame([("A", "1"), ("b", "1"), ("a", "2"), ("c", "3"), ("c", "3"), (None, None)], "id string, arxiv_id string")
    links = spark.createDataFrame([("l1", "A", True), ("l2", "a", True), ("l3", "a", False), ("l4", "z", False)], "id string, paper_id string, is_selected boolean")
    got = {(r.table_name, r.rule): r.n_keys for r in key_violations({"papers": papers, "paper_repo_links": links}).collect()}
    assert got == {("papers", "unique (id)"): 1, ("papers", "unique (arxiv_id)"): 1, ("paper_repo_links", "unique (id)"): 0, ("paper_repo_links", "unique (paper_id) where is_selected"): 1, ("paper_repo_links", "paper_id in papers"): 1}
    row = with_defaults(papers.limit(1), "papers", "2025-01-01 00:00:00").first()
    assert row.status == "DISCOVERED" and str(row.updated_at) == "2025-01-01 00:00:00" and row.title is None


def test_candidates_and_selected(spark):
    rows = [("l2", "P", 2, False), ("l1", "p", 1, False), ("l1", "p", 1, False), ("l3", "q", None, True), ("l0", "q", 3, True), ("l9", None, 1, True)]
    links = spark.createDataFrame(rows, "id string, paper_id string, evidence_strength int, is_selected boolean")
    assert {(r.id, r.candidate_no) for r in ordered_candidates(links).collect()} == {("l1", 1), ("l2", 2), ("l0", 1), ("l3", 2)}
    assert {r.id for r in ordered_candidates(links, spark.createDataFrame([("Q",)], "id string")).collect()} == {"l0", "l3"}
    assert [r.id for r in selected_links(links).collect()] == ["l0"]
