"""Requests from tables of URLs and prompts against a server of one's own."""

import json
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ledgerline.grounding import clients as C
from ledgerline.grounding.checks import REVIEW as SHAPE
from ledgerline.grounding.checks import decode_strict
from ledgerline.grounding.pipeline import run_pipeline
from ledgerline.grounding.providers import adjudicate_prompt, extract_prompt, review_prompt
from ledgerline.sources.live import Client, fetch_pages, look_up_repositories

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture()
def server():
    """Scripted answers by path: a list of (status, headers, body), the last one again and again; what was asked is kept."""

    class Handler(BaseHTTPRequestHandler):
        def reply(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            with lock:
                asked.append((self.path, dict(self.headers), body))
                answers = script[self.path.partition("?")[0]]
                status, headers, text = answers.pop(0) if len(answers) > 1 else answers[0]
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(text.encode())

        do_GET = do_POST = reply

        def log_message(self, *_):
            pass

    script, asked, lock = {}, [], threading.Lock()
    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", script, asked
    made.shutdown()
    made.server_close()


QUICK = Client(attempts=3, base=0.0, jitter=0.0)


def test_pages_from_a_table(spark, server):
    at, script, asked = server
    script |= {"/ok": [(200, {}, "é")], "/late": [(500, {}, ""), (200, {}, "x")], "/down": [(503, {}, "no")], "/gone": [(404, {}, "no")], "/moved": [(302, {"Location": "/ok"}, "there")], "/limit": [(429, {}, "")]}
    names = ["ok", "late", "down", "gone", "moved", "limit"]
    urls = spark.createDataFrame([(f"{at}/{n}", "x") for n in names] + [(None, "x")], "url string, body string")
    got = {r.url.rpartition("/")[2]: (r.http_status, r.body, r.fetch_status, r.attempts) for r in fetch_pages(urls, at_once=3, client=QUICK).collect()}
    assert got == {"ok": (200, "é", "OK", 1), "late": (200, "x", "OK", 2), "down": (None, None, "TIMEOUT", 3), "gone": (None, None, "ERROR", 1), "moved": (302, "there", "OK", 1), "limit": (None, None, "TIMEOUT", 3)}
    assert fetch_pages(urls.limit(0), client=QUICK).count() == 0
    assert not any(path == "/ok" and h.get("Referer") for path, h, _ in asked)


def test_no_answer_and_an_own_transport(spark):
    def transport(method, url, headers, body, seconds):
        return (200, json.dumps({"stargazers_count": 3}).encode(), {}) if url.endswith("a/b") else (None, b"", {"error": "timeout"})

    repos = spark.createDataFrame([("https://github.com/a/b.git",), ("https://github.com/c/d",), ("nothing",)], "repo_url string")
    got = {r.repo_url: (r.api_status, r.stargazers_count) for r in look_up_repositories(repos, client=Client(attempts=2, base=0.0, jitter=0.0, transport=transport)).collect()}
    assert got == {"https://github.com/a/b.git": ("OK", 3), "https://github.com/c/d": ("ERROR", None), "nothing": ("ERROR", None)}
    page = fetch_pages(spark.createDataFrame([("http://127.0.0.1:9/x",), ("no url",)], "url string"), client=QUICK).collect()
    assert {r.fetch_status for r in page} == {"TIMEOUT"} and all(r.content_hash.startswith("e3b0c442") for r in page)


def test_repositories_from_a_table(spark, server):
    at, script, asked = server
    script |= {"/repos/o/ok": [(200, {}, '{"stargazers_count": 7}')], "/repos/o/none": [(404, {}, "")], "/repos/o/limit": [(403, {"x-ratelimit-remaining": "0"}, "")], "/repos/o/denied": [(403, {"X-RateLimit-Remaining": "5"}, "")], "/repos/o/down": [(500, {}, "")], "/repos/o/odd": [(200, {}, "[")]}
    repos = spark.createDataFrame([(f"https://github.com/o/{n}",) for n in ("ok", "none", "limit", "denied", "down", "odd")], "repo_url string")
    got = {r.repo_url.rpartition("/")[2]: (r.api_status, r.stargazers_count, r.exists_verified) for r in look_up_repositories(repos, client=QUICK, api_base=at, token="T").collect()}
    assert got == {"ok": ("OK", 7, True), "none": ("NOT_FOUND", None, False), "limit": ("RATE_LIMITED", None, False), "denied": ("ERROR", None, False), "down": ("ERROR", None, False), "odd": ("ERROR", None, False)}
    calls = [p.rpartition("/")[2] for p, _, _ in asked]
    assert {n: calls.count(n) for n in set(calls)} == {"ok": 1, "none": 1, "limit": 3, "denied": 1, "down": 3, "odd": 1}
    assert all(h["Authorization"] == "Bearer T" and h["Accept"].endswith("json") for _, h, _ in asked)


X = json.dumps({"company": None, "role_family": None, "is_remote": None, "summary": None, "evidence_quotes": [], "claims": []})
REVIEW = json.dumps({"corrected_extraction": json.loads(X), "corrections": [], "added_information": [], "removed_information": [], "review_status": "ACCEPTED"})
BODIES = {
    "gemini": lambda t: json.dumps({"steps": [{"type": "thought"}, {"type": "model_output", "content": [{"type": "text", "text": t}]}]}),
    "cohere": lambda t: json.dumps({"message": {"content": [{"type": "text", "text": t}]}}),
    "groq": lambda t: json.dumps({"choices": [{"message": {"content": t}}]}),
}


def providers(at):
    return [C.HttpProvider(n, "KEY", url=f"{at}/{n}", sleep=lambda s: None) for n in ("gemini", "cohere", "groq")]


def test_three_stages_over_http(spark, server):
    at, script, asked = server
    script |= {"/gemini": [(429, {"Retry-After": "0"}, ""), (200, {}, BODIES["gemini"](X))], "/cohere": [(200, {}, BODIES["cohere"](REVIEW))], "/groq": [(500, {}, ""), (200, {}, BODIES["groq"](X))]}
    r = run_pipeline(spark.createDataFrame([("Acme hires.",)], "evidence string"), "evidence", *providers(at)).first()
    assert (r.exit, r.validation_status, r.validation_errors) == ("complete", "VALIDATED", [])
    assert r.first_attempt.success and r.second_attempt.provider == "cohere" and r.third_attempt.model == ""
    bodies = {p: (h, json.loads(b)) for p, h, b in asked}
    assert [p for p, _, _ in asked] == ["/gemini", "/gemini", "/cohere", "/groq", "/groq"]
    assert bodies["/gemini"][0]["X-Goog-Api-Key"] == "KEY" and "Acme hires." in bodies["/gemini"][1]["input"]
    assert bodies["/cohere"][0]["Authorization"] == "Bearer KEY" and "review_status" in bodies["/cohere"][1]["response_format"]["schema"]["properties"]
    assert [m["role"] for m in bodies["/groq"][1]["messages"]] == ["system", "user"] and bodies["/groq"][1]["temperature"] == 0


def test_fallback_and_errors_over_http(spark, server):
    at, script, asked = server
    script |= {"/gemini": [(429, {}, "")], "/cohere": [(200, {}, BODIES["cohere"](X))], "/groq": [(413, {}, "")]}
    df = spark.createDataFrame([("Acme hires.",)], "evidence string")
    r = run_pipeline(df, "evidence", *providers(at)).first()
    assert r.exit == "fallback_adjudication_failed" and r.second_attempt.provider == "cohere-fallback-extract"
    assert r.validation_errors == ["Gemini extraction failed: HTTP 429 after 3 attempts", "Cohere fallback extraction succeeded", "Groq adjudication failed: HTTP 413: the request is too large"]
    script["/groq"] = [(200, {}, BODIES["groq"](X))]
    r = run_pipeline(df, "evidence", *providers(at)).first()
    assert (r.exit, r.validation_status, r.validation_errors[1]) == ("fallback", "VALIDATED", "Cohere fallback extraction used")
    script["/cohere"] = [(400, {}, "bad")]
    r = run_pipeline(df, "evidence", *providers(at)).first()
    assert r.exit == "no_extraction" and r.validation_errors[1] == "Cohere fallback extraction failed: HTTP 400: bad" and r.third_attempt is None


def test_roles(spark):
    gemini, cohere, groq = providers("x")
    df = spark.createDataFrame([("e",)], "evidence string")
    for order in ((groq, groq, groq), (gemini, gemini, groq), (gemini, cohere, cohere)):
        with pytest.raises(NotImplementedError):
            run_pipeline(df, "evidence", *order)


def test_waits_and_answers():
    assert [C.wait_after(429, n, v) for n, v in ((0, None), (2, None), (0, "7"), (0, "99"), (0, "soon"))] == [1, 4, 7, 30, 2]
    assert [C.wait_after(s, 5, None) for s in (500, None, 501, 200)] == [10, 10, None, None]
    for kind, odd in (("gemini", {"steps": None}), ("gemini", []), ("cohere", {"message": {"content": []}}), ("cohere", {}), ("groq", {"choices": []}), ("groq", {"choices": [{"message": None}]})):
        with pytest.raises(C.ProviderError):
            C.answer_text(kind, odd)
    assert C.answer_text("cohere", {"message": {"content": "plain"}}) == "plain"
    waited, answers = [], [(None, b"", {"error": "timeout"}), (503, b"", {}), (200, b"{", {})]
    with pytest.raises(C.ProviderError, match="isn't JSON"):
        C.post(lambda *a: answers.pop(0), "u", {}, {}, 1.0, sleep=waited.append)
    assert len(waited) == 2 and 1 <= waited[0] <= 1.5 and 2 <= waited[1] <= 2.5


def test_prompts(spark):
    df = spark.createDataFrame([("Ev", '{"a":"é"}')], "e string, d string")
    e, d = F.col("e"), F.col("d")
    prompts = [extract_prompt(e), extract_prompt(e, True), review_prompt(e, d), review_prompt(e, d, True), adjudicate_prompt(e, d, d), adjudicate_prompt(e, d, d, True)]
    texts = list(df.select(*prompts).first())
    assert len(set(texts)) == 6 and all("Ev" in t for t in texts)
    assert all('{\n  "a": "é"\n}' in t for t in texts[2:]) and texts[4].count('"a": "é"') == 2


def test_strict_decoding(spark):
    review = lambda **c: json.dumps(json.loads(REVIEW) | c)
    good = [X, "{}", ' {"company": "a", "more": [1]}', '{"claims": [{"field": "f", "value": true}, {"field": "g", "value": "v", "evidence_quote": null}]}']
    bad = [None, "", "[]", "nope", '"x"', '{"is_remote": "perhaps"}', '{"evidence_quotes": "q"}', '{"claims": [{"value": "v"}]}', '{"claims": [null]}', '{"claims": ["c"]}', '{"company": "a"']
    df = spark.createDataFrame([(t, t in good) for t in good + bad], "t string, good boolean")
    rows = df.select("t", "good", decode_strict(F.col("t")).isNotNull().alias("got")).collect()
    assert [r.t for r in rows if r.good != r.got] == []
    bad = [review(review_status="ODD"), review(corrected_extraction=None), review(corrections="c"), X]
    df = spark.createDataFrame([(t, t not in bad) for t in [REVIEW, review(corrections=["c"]), *bad]], "t string, good boolean")
    rows = df.select("t", "good", decode_strict(F.col("t"), SHAPE).isNotNull().alias("got")).collect()
    assert [r.t for r in rows if r.good != r.got] == []
