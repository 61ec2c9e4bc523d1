import json
import random
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ledgerline.functions.urls import repo_url
from ledgerline.grounding.checks import EXTRACTION, decode, ground
from ledgerline.grounding.pipeline import run_pipeline
from ledgerline.grounding.providers import response_text
from ledgerline.operators import relational as R
from ledgerline.operators.associate import select_primary
from ledgerline.operators.validate import build_exports
from ledgerline.schemas import TABLES, split_valid
from ledgerline.sources.attempts import fold_attempts, page_outcome, repo_outcome
from ledgerline.sources.feed import discovered, feed_papers, page_plan
from ledgerline.sources.log import events
from ledgerline.sources.pages import anchors, link_candidates
from ledgerline.sources.replay import HttpPages, RepoLookups, replay_pages
from ledgerline.sources.sheet import chunked, sheet_rows, write_sheet
from ledgerline.streaming.incremental import ingest, ingest_stream
from ledgerline.tables import SnapshotStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the stub providers run on executors
T0 = datetime(2025, 1, 1)
LINK = '<a href="https://github.com/{0}">{1}</a>'
PAGES = {
    "chrome": f'<nav>{LINK.format("no/nav", "x")}</nav><td class="tablecell comments">{LINK.format("a/b", "code")}</td><footer>{LINK.format("no/foot", "x")}</footer>',
    "two": f'<blockquote class="abstract mathjax">{LINK.format("a/b", "one")} {LINK.format("c/d", "two")}</blockquote>',
    "none": "<blockquote class='abstract'>text</blockquote>",
    "other": '<blockquote class="abstract"><a href="https://gitlab.com/a/b">x</a></blockquote>',
    "sub": f'<blockquote class="abstract">{LINK.format("a/b/tree/main", "t")}{LINK.format("a/b/blob/x.py", "u")}</blockquote>',
    "order": f'<td class="tablecell comments">{LINK.format("a/b/", "late")}</td><blockquote class="abstract"><p>{LINK.format("a/b", "<b>ear</b> ly")}</blockquote>',
    "bad": f'<blockquote class="abstract">{LINK.format("topics/ai", "x")}{LINK.format("solo", "y")}</blockquote>',
    "loose": f'<div class="extra-services"><p>open<br>{LINK.format("q/r", "")}</i></div>{LINK.format("no/after", "x")}',
    "script": '<script>var t="<td class=\'tablecell comments\'>";</script><a href="https://github.com/no/script">x</a>',
}


def test_links_and_choice(spark):
    pages = spark.createDataFrame([(k, "u", v, T0) for k, v in PAGES.items()] + [("null", "u", None, T0), ("empty", "u", "", T0)], "id string, url string, html string, at timestamp")
    found = link_candidates(anchors(pages, "id", "url", "html", "at"))
    by = {}
    for r in found.collect():
        by.setdefault(r.page_id, {})[r.repo_url.rpartition("github.com/")[2]] = (r.evidence_text, r.evidence_locator)
    assert {k: sorted(v) for k, v in by.items()} == {"chrome": ["a/b"], "two": ["a/b", "c/d"], "sub": ["a/b"], "order": ["a/b"], "loose": ["q/r"]}
    assert by["order"]["a/b"][0] == "early" and by["loose"]["q/r"] == (None, "<a> in div.extra-services")
    assert by["chrome"]["a/b"][1] == "<a> in td.tablecell.comments, text='code'"
    chosen = {r.page_id: r.selected for r in select_primary(found, "page_id", "repo_url").collect()}
    assert chosen["two"] is None and chosen["chrome"] == "https://github.com/a/b"


def test_select_primary_against_plain_python(spark):
    rng = random.Random(1)
    rows = [(f"g{g}", f"{g}-{k}", rng.randint(1, 3), rng.choice([None, "x", "Official repo", "td"])) for g in range(150) for k in range(rng.randint(1, 4))]
    got = {r.g: r.selected for r in select_primary(spark.createDataFrame(rows, "g string, id string, evidence_strength int, evidence_locator string"), "g", "id").collect()}
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        best = [r for r in mine if r[2] == min(m[2] for m in mine)]
        official = [r for r in best if r[3] and "official" in r[3].lower()]
        assert got[g] == (best[0][1] if len(best) == 1 else official[0][1] if len(official) == 1 else None)


def test_table_changes(spark):
    old = spark.createDataFrame([("a", T0, T0, "x"), ("b", T0, T0, None)], "k string, f timestamp, l timestamp, other string")
    seen = spark.createDataFrame([("a", T0 + timedelta(1)), ("a", T0 - timedelta(1)), ("c", T0 + timedelta(2)), ("c", T0), (None, T0)], "k string, at timestamp")
    up = {r.k: (r.f, r.l, r.other) for r in R.upsert_seen(old, seen, "k", "f", "l").collect()}
    assert up == {"a": (T0, T0 + timedelta(1), "x"), "b": (T0, T0, None), "c": (T0, T0 + timedelta(2), None)}
    once = R.put_if_absent(old, old.unionByName(old.withColumn("k", F.lit("z"))), ["k"])
    assert sorted(r.k for r in R.put_if_absent(once, once, ["k"]).collect()) == ["a", "b", "z"]
    new = spark.createDataFrame([("a", None)], "key string, other string")
    changed = R.overwrite_fields(old.withColumn("key", F.col("k")), new, "key", ["other"])
    assert {r.k: r.other for r in changed.collect()} == {"a": None, "b": None}
    won = R.last_writer_wins(old, spark.createDataFrame([("a", T0, T0, "1"), ("a", T0, T0 + timedelta(1), "2")], old.schema), ["k"], "l")
    assert {r.k: r.other for r in won.collect()} == {"a": "2", "b": None}
    status = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", None)], "id string, status string")
    after, claimed = R.claim(status, "X", "Z")
    assert {r.id: r.status for r in after.collect()} == {"a": "Z", "b": "Y", "c": None} and claimed.count() == 1
    marked = R.set_for_ids(status, status.where("id = 'b'"), "id", status=F.lit("M"))
    assert {r.id: r.status for r in marked.collect()} == {"a": "X", "b": "M", "c": None}
    assert R.set_for_ids(status, status.limit(0), "id", status=F.lit("M")).where("status = 'M'").count() == 0


def test_lineage_unites_both_ways(spark):
    obs = spark.createDataFrame([("O1", "P1"), ("o2", None), ("o3", "p1"), ("o3", "p1")], "id string, paper_id string")
    links = spark.createDataFrame([("p1", "o1"), ("p1", "o2"), ("p2", "o2"), ("p1", "gone"), (None, "o2")], "paper_id string, fetch_observation_id string")
    got = R.observations_of_papers(obs, links).collect()
    assert sorted((r.asked_paper_id, r.id) for r in got) == [("p1", "O1"), ("p1", "o2"), ("p1", "o3"), ("p2", "o2")]


@pytest.mark.parametrize(
    "codes, expected",
    [([(200, None)], ("OK", 1, 0.0)), ([(404, None)], ("NOT_FOUND", 1, 0.0)), ([(429, None)] * 2, ("RATE_LIMITED", 2, 1.0)), ([(403, "0")] * 2, ("RATE_LIMITED", 2, 1.0)), ([(403, "5")], ("ERROR", 1, 0.0)), ([(500, None)] * 3, ("ERROR", 3, 3.0)), ([(None, None)] * 2 + [(200, None)], ("OK", 3, 3.0)), ([(500, None)] * 9, ("ERROR", 5, 15.0))],
)
def test_attempts(spark, codes, expected):
    log = spark.createDataFrame([("k", n, c, r) for n, (c, r) in enumerate(codes)], "k string, n int, code int, rest string")
    r = fold_attempts(log, "k", "n", repo_outcome(F.col("code"), F.col("rest"))).first()
    assert (r.api_status, r.attempts_used, r.waited) == expected


def test_replay_and_source(spark):
    recorded = spark.createDataFrame([("a", 1, 500, None), ("a", 2, 200, "hi"), ("b", 1, 404, None), ("c", 1, None, None), ("c", 2, 500, None), ("c", 3, 500, None)], "url string, attempt int, http_status int, body string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "url string")
    got = {r.url: (r.http_status, r.body, r.fetch_status, r.attempts, r.content_hash[:8]) for r in replay_pages(asked, recorded, 3).collect()}
    assert got["a"][:4] == (200, "hi", "OK", 2) and got["b"] == (None, None, "ERROR", 1, "e3b0c442")
    assert got["c"][2:4] == ("TIMEOUT", 3) and got["d"][2:4] == ("TIMEOUT", 3)
    spark.dataSource.register(HttpPages)
    rows = spark.read.format("http_pages").options(urls=json.dumps(["http://127.0.0.1:9/x"]), attempts="2", base="0.01", jitter="0").load().collect()
    assert [(r.fetch_status, r.attempts, r.body) for r in rows] == [("TIMEOUT", 2, None)]
    assert spark.createDataFrame([(302,)], "s int").select(page_outcome(F.col("s"))).first()[0] == "OK"


def test_repo_lookups(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    calls = {}

    class Api(BaseHTTPRequestHandler):
        def do_GET(self):
            name = self.path.rpartition("/")[2]
            calls[name] = calls.get(name, 0) + 1
            code, body, remaining = {"ok": (200, '{"stargazers_count": 7}', "5"), "bare": (200, "{}", "5"), "none": (404, "", "5"), "limit": (403, "", "0"), "denied": (403, "", "5"), "down": (500, "", "5"), "wait": (429, "", "5"), "minus": (200, '{"stargazers_count": -1}', "5")}[name]
            self.send_response(code)
            self.send_header("X-RateLimit-Remaining", remaining)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(RepoLookups)
        urls = [f"https://github.com/o/{n}" for n in ("ok.git", "bare", "none", "limit", "denied", "down", "wait", "minus")] + ["junk"]
        rows = spark.read.format("repo_lookups").options(urls=json.dumps(urls), api_base=f"http://127.0.0.1:{server.server_port}", attempts="3", base="0", jitter="0", partitions="2").load().collect()
    finally:
        server.shutdown()
    got = {r.repo_url.rpartition("/")[2]: (r.api_status, r.stargazers_count, r.exists_verified) for r in rows}
    assert got == {"ok.git": ("OK", 7, True), "bare": ("OK", None, True), "none": ("NOT_FOUND", None, False), "limit": ("RATE_LIMITED", None, False), "denied": ("ERROR", None, False), "down": ("ERROR", None, False), "wait": ("RATE_LIMITED", None, False), "minus": ("OK", None, True), "junk": ("ERROR", None, False)}
    assert calls == {"ok": 1, "bare": 1, "none": 1, "limit": 3, "denied": 1, "down": 3, "wait": 3, "minus": 1}


ATOM = '<feed xmlns="http://www.w3.org/2005/Atom">{}</feed>'
ENTRY = "<entry><id>http://h/abs/{0}v1</id><title> A \n  b </title><summary>{2}</summary><published>{1}</published>{3}</entry>"
AUTHOR = "<author><name> Ann </name></author>"


def test_feed_papers_and_rejects(spark):
    xml = ATOM.format(ENTRY.format("1", "2025-01-02T03:04:05Z", " ", AUTHOR) + ENTRY.format("2", "2025-01-02T03:04:05Z", "", "") + "<entry><title>x</title>" + AUTHOR + "</entry>" + ENTRY.format("4", "yesterday", "s", AUTHOR))
    papers, rejects = feed_papers(spark.createDataFrame([("f", xml), ("bad", "<feed"), ("n", None)], "id string, xml string"), "id", "xml")
    p = papers.collect()
    assert [(r.arxiv_id, r.title, r.authors, r.abstract) for r in p] == [("1", "A b", ["Ann"], "")] and p[0].published_date == datetime(2025, 1, 2, 3, 4, 5)
    assert {(r.entry_no, r.reason) for r in rejects.collect()} == {(2, "no authors"), (3, "no id"), (4, "bad date")}


def test_page_plan_and_stops(spark):
    assert [r.start for r in page_plan(spark, "b", 250, 100).orderBy("start").collect()] == [0, 100, 200]
    rows = [("r", 0, False, "<entry>"), ("r", 1, False, "none"), ("r", 2, False, "<entry>"), ("s", 0, False, "<entry>"), ("s", 1, True, None), ("s", 2, False, "<entry>"), ("t", 0, False, None)]
    got = discovered(spark.createDataFrame(rows, "run string, start int, failed boolean, body string"), "run", "start", "failed", "body")
    assert sorted((r.run, r.start) for r in got.collect()) == [("r", 0), ("r", 1), ("s", 0), ("t", 0)]


def test_switches(spark):
    pages = spark.createDataFrame([("r", 0, False, "<a:entry x='1'>"), ("r", 1, False, "<entry>")], "run string, start int, failed boolean, body string")
    assert discovered(pages, "run", "start", "failed", "body").count() == 1
    assert discovered(pages, "run", "start", "failed", "body", entry=r"<(\w+:)?entry[\s/>]").count() == 2
    papers = spark.createDataFrame([("P", "RESOLVED", T0)], "id string, status string, first_seen_at timestamp")
    links = spark.createDataFrame([("p", "https://github.com/a/b", True)], "paper_id string, repo_url string, is_selected boolean")
    snaps = spark.createDataFrame([("https://github.com/a/b/", "RATE_LIMITED")], "repo_url string, api_status string")
    url = repo_url(F.col("repo_url"))
    assert R.unverified(papers, links, snaps, url).count() == 0 and R.unverified(papers, links, snaps, url, any_status=False).count() == 1


def test_exports_gate_and_rejects(spark):
    papers = spark.createDataFrame([("P1", "1", "u1", "T", ["a", None, "b"], T0), ("p2", "2", "u2", " \xa0", ["a"], None), ("p3", "3", "u3", "T", [], None), ("p4", " ", "u4", "", None, None), ("p5", "5", "u5", "T", ["a"], None)], "id string, arxiv_id string, canonical_url string, title string, authors array<string>, published_date timestamp")
    links = spark.createDataFrame([("l1", "p1", "https://github.com/a/b", "t", True), ("l5", "p5", "https://github.com/c/d", "t", True), ("l6", "p5", "https://github.com/a/b", "t", False)], "id string, paper_id string, repo_url string, evidence_type string, is_selected boolean")
    snaps = spark.createDataFrame([("s1", "https://github.com/a/b/", True, "OK", 1, T0), ("s2", "https://github.com/a/b", True, "OK", 2, T0 + timedelta(1)), ("s3", "https://github.com/c/d", True, "OK", 2, T0), ("s4", "https://github.com/c/d", False, "RATE_LIMITED", None, T0 + timedelta(1))], "id string, repo_url string, exists_verified boolean, api_status string, stargazers_count int, stars_fetched_at timestamp")
    good, bad = build_exports(papers, links, snaps, repo_url, "2025-03-01 00:00:00")
    rows = {r.paper_id: r for r in good.collect()}
    assert rows["P1"].github_stars == 2 and rows["P1"].github_url == "https://github.com/a/b" and rows["P1"].published_date == "2025-01-01T00:00:00+00:00"
    assert rows["p5"].github_url is None and rows["p5"].github_stars is None and rows["p5"].github_evidence_type is None
    assert {(r.paper_id, r.reason) for r in bad.collect()} == {("p2", "empty title"), ("p3", "no authors"), ("p4", "missing arxiv_id")}
    sheet = {r.paper_id: r for r in sheet_rows(good).collect()}
    assert sheet["P1"].authors == "a; b" and sheet["p5"].github_stars == ""


def test_sheet_chunks_and_write(spark, tmp_path):
    rows = spark.range(1234).select(F.col("id").alias("n"))
    by = {r.n: r.chunk for r in chunked(rows, ["n"], 500).collect()}
    assert by == {n: (n + 1) // 500 for n in range(1234)}
    write_sheet(rows, str(tmp_path), "s")
    write_sheet(rows, str(tmp_path), "s")
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 1234
    with pytest.raises(ValueError):
        write_sheet(rows, None, "s")


def test_row_checks_and_log(spark):
    df = spark.createDataFrame([("a", "u", True, 1, T0, "OK"), ("b", "u", True, -1, T0, "OK"), ("c", "u", None, 1, T0, "OK"), ("d", "u", True, 1, T0, "odd")], TABLES["github_repo_snapshots"])
    good, bad = split_valid(df, "github_repo_snapshots")
    assert [r.id for r in good.collect()] == ["a"]
    assert {r.id: r.violation for r in bad.collect()} == {"b": "stargazers_count: negative", "c": "exists_verified: missing", "d": "api_status: not in its domain"}
    logged = events(df, "verify", F.col("api_status"), "2025-03-01", ["stargazers_count"], record_id=F.col("id")).where("record_id = 'b'").first()
    assert logged.detail == '{"stargazers_count":-1}' and logged.stage == "verify" and logged.attempt is None


EVIDENCE = "Acme hires an engineer. Work is remote."


def extraction(**change):
    x = {"company": "Acme", "role_family": None, "is_remote": False, "summary": None, "evidence_quotes": ["Acme hires"], "claims": [{"field": "company", "value": "Acme", "evidence_quote": "Acme hires", "supported": True}, {"field": "is_remote", "value": False, "evidence_quote": "Work is remote.", "supported": True}]}
    return json.dumps(x | change)


def test_grounding_rules(spark):
    claim = lambda **c: [{"field": "company", "value": "Acme", "evidence_quote": "Acme hires", "supported": True} | c]
    cases = {
        "good": (extraction(), []),
        "quote": (extraction(evidence_quotes=["acme", ""]), ["Evidence quote not found in source: acme"]),
        "noquote": (extraction(is_remote=None, claims=claim(evidence_quote=None)), ["Supported claim has no evidence quote: company"]),
        "novalue": (extraction(is_remote=None, claims=claim(value=None)), ["Supported claim has no value: company"]),
        "unsupported": (extraction(is_remote=None, claims=claim(supported=False, evidence_quote=None)), ["Non-null field has no supported claim: company"]),
        "field": (extraction(claims=claim()), ["Non-null field has no supported claim: is_remote"]),
        "both": (extraction(is_remote=None, claims=claim(value=None, evidence_quote="nope")), ["Claim evidence quote not found in source: company", "Supported claim has no value: company"]),
    }
    df = spark.createDataFrame([(k, EVIDENCE, v[0]) for k, v in cases.items()] + [("unread", EVIDENCE, None)], "k string, evidence string, x string")
    got = {r.k: (r.validation_status, list(r.validation_errors)) for r in ground(df.withColumn("d", decode(F.col("x"), EXTRACTION)), "evidence", "d").collect()}
    for k, (_, errors) in cases.items():
        assert got[k] == ("QUARANTINE" if errors else "VALIDATED", errors)
    assert got["unread"][0] == "QUARANTINE"


class Stub:
    model = "stub"

    def __init__(self, name, answers):
        self.name, self.answers = name, answers

    def answer(self, prompts):
        out = []
        for p in prompts:
            kind = p.partition("Evidence:\n")[2].split(".")[0]
            a = self.answers.get(kind, self.answers.get("*"))
            if a == "raise":
                raise RuntimeError("no answer")
            out.append(a)
        return out


def test_pipeline_exits(spark):
    ok = extraction(company=None, is_remote=None, claims=[], evidence_quotes=[])
    review = json.dumps({"corrected_extraction": json.loads(ok), "corrections": [], "added_information": [], "removed_information": [], "review_status": "ACCEPTED"})
    names = ["complete", "no_extraction", "fallback", "fallback_adjudication_failed", "review_failed", "adjudication_failed"]
    first = Stub("1", {"no_extraction": None, "fallback": "raise", "fallback_adjudication_failed": "not json", "*": ok})
    second = Stub("2", {"no_extraction": None, "fallback": ok, "fallback_adjudication_failed": ok, "review_failed": '{"review_status": "ODD"}', "*": review})
    third = Stub("3", {"fallback_adjudication_failed": None, "adjudication_failed": None, "*": ok})
    df = spark.createDataFrame([(n + ".",) for n in names], "evidence string")
    got = {r.evidence[:-1]: r for r in run_pipeline(df, "evidence", first, second, third).collect()}
    assert {n: got[n].exit for n in names} == {n: n for n in names}
    assert got["complete"].validation_status == "VALIDATED" and got["complete"].validation_errors == []
    assert got["fallback"].validation_status == "VALIDATED" and len(got["fallback"].validation_errors) == 2
    assert got["review_failed"].validation_status == "QUARANTINE"


def test_response_text(spark):
    bodies = {"gemini": {"steps": [{"type": "thought"}, {"type": "model_output", "content": [{"type": "text", "text": "G"}]}]}, "cohere": {"message": {"content": [{"type": "text", "text": "C"}]}}, "groq": {"choices": [{"message": {"content": "Q"}}]}}
    for p, b in bodies.items():
        assert spark.createDataFrame([(json.dumps(b),)], "b string").select(response_text(F.col("b"), p)).first()[0] == {"gemini": "G", "cohere": "C", "groq": "Q"}[p]


def observations(spark, rows):
    full = [(i, None, "s", "u", (x, None), "h", T0 + timedelta(n), 200, "OK") for n, (i, x) in enumerate(rows)]
    return spark.createDataFrame(full, TABLES["fetch_observations"])


def test_store_and_incremental_ingest(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.migrate()
    store.migrate()
    assert store.read("papers").count() == 0 and store.version("papers") == 1
    two = ATOM.format(ENTRY.format("1", "2025-01-02T03:04:05Z", "s", AUTHOR) + ENTRY.format("2", "2025-01-02T03:04:05Z", "s", AUTHOR))
    ingest(store, observations(spark, [("o1", two), ("bad", "<feed")]))
    ingest(store, observations(spark, [("o1", two), ("bad", "<feed")]))
    ingest(store, observations(spark, [("o2", two)]))
    assert [store.read(t).count() for t in ("papers", "fetch_observations", "paper_fetch_observations")] == [2, 3, 4]
    observations(spark, [("o3", ATOM.format(ENTRY.format("3", "2025-01-02T03:04:05Z", "s", AUTHOR)))]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TABLES["fetch_observations"]).parquet(str(tmp_path / "in"))
    ingest_stream(store, stream, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.read("papers").count() == 3
    assert len(store._folders("papers")) > 2
    before = sorted(map(tuple, store.read("paper_fetch_observations").collect()))
    store.compact("paper_fetch_observations")
    assert len(store._folders("paper_fetch_observations")) == 1 and sorted(map(tuple, store.read("paper_fetch_observations").collect())) == before


def test_many_appends_make_few_folders(spark, tmp_path, monkeypatch):
    from ledgerline import tables

    monkeypatch.setattr(tables, "MOST_FOLDERS", 4)
    store = SnapshotStore(spark, str(tmp_path / "store"))
    for k in range(9):
        store.append("paper_fetch_observations", spark.createDataFrame([(f"p{k}", "o")], "paper_id string, fetch_observation_id string"))
        assert len(store._folders("paper_fetch_observations")) <= 4
        assert sorted(r.paper_id for r in store.read("paper_fetch_observations").collect()) == [f"p{n}" for n in range(k + 1)]
