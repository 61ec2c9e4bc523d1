"""Asking over HTTP from tables of requests: each task asks for its rows, with retries; outcomes are rows, never exceptions.

A transport is what sends one request: (method, url, headers, body or None, seconds) -> (status or None, body, headers). It runs on the executors, so
a test hands over its own; the default is the standard library's client, which doesn't follow redirections.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Answer = tuple[int | None, bytes, dict[str, str]]
Transport = Callable[[str, str, dict[str, str], bytes | None, float], Answer]

SNAPSHOT = "repo_url string, exists_verified boolean, stargazers_count int, stars_fetched_at timestamp, api_status string"
RESPONSE = "url string, http_status int, body string, content_hash string, fetch_status string, attempts int"
# What the repository host's REST interface expects, and how it says that no requests are left.
REPO_HEADERS = {"Accept": "application/vnd.github+json", "X-GitHub-Api-Version": "2026-03-10"}
REMAINING = "X-RateLimit-Remaining"


#: Answers that are held before they are handed on.
_HANDED = 64


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def send(method: str, url: str, headers: dict[str, str], body: bytes | None, seconds: float) -> Answer:
    """One request by the standard library. No answer is status None, with the kind of failure in the headers under `error`."""
    try:
        request = urllib.request.Request(url, body, {"User-Agent": "ledgerline", **headers}, method=method)
        with urllib.request.build_opener(_Stay).open(request, timeout=seconds) as r:
            return r.status, r.read(), dict(r.headers)
    except urllib.error.HTTPError as e:
        with e:
            return e.code, e.read(), dict(e.headers)
    except (OSError, ValueError) as e:
        late = isinstance(e, TimeoutError) or isinstance(getattr(e, "reason", None), TimeoutError)
        return None, b"", {"error": "timeout" if late else str(e) or type(e).__name__}


@dataclass(frozen=True)
class Client:
    """How requests are sent: attempts, backoff base * 2^n up to most plus jitter, seconds for an answer, a delay after each request, headers, transport."""

    attempts: int = 5
    base: float = 1.0
    most: float = 60.0
    jitter: float = 0.5
    timeout: float = 20.0
    delay: float = 0.0
    headers: dict[str, str] = field(default_factory=dict)
    transport: Transport = send
    sleep: Callable[[float], None] = time.sleep

    def ask(self, url: str, again: Callable[[int | None, dict[str, str]], bool]) -> tuple[int | None, bytes, dict[str, str], int]:
        """The last answer and the attempts used; again(status, headers) says whether an answer is worth another try. No wait after the last."""
        status, body, headers, used = None, b"", {}, 0
        for used in range(1, max(1, self.attempts) + 1):
            status, body, headers = self.transport("GET", url, self.headers, None, self.timeout)
            if not again(status, headers):
                break
            if used < self.attempts:
                self.sleep(min(self.base * 2 ** (used - 1), self.most) + random.uniform(0, self.jitter))
        if self.delay:
            self.sleep(self.delay)
        return status, body, headers, used


def page_again(status: int | None, _: dict[str, str]) -> bool:
    return status is None or status == 429 or status >= 500


def page_row(client: Client, url: str) -> tuple:
    """A row of RESPONSE: OK (redirections as they are); ERROR for other answers from 400 on; TIMEOUT when all attempts failed. Only OK pages have a body."""
    status, body, _, used = client.ask(url, page_again)
    outcome = "TIMEOUT" if page_again(status, {}) else "ERROR" if status >= 400 else "OK"
    good = outcome == "OK"
    raw = body if good else b""
    return url, status if good else None, raw.decode("utf-8", "replace") if good else None, hashlib.sha256(raw).hexdigest(), outcome, used


def _limited(status: int | None, headers: dict[str, str]) -> bool:
    return status == 429 or (status == 403 and {k.lower(): v for k, v in headers.items()}.get(REMAINING.lower()) == "0")


def repo_again(status: int | None, headers: dict[str, str]) -> bool:
    return status is None or status >= 500 or _limited(status, headers)


def repo_row(client: Client, url: str, api_base: str, host: str) -> tuple:
    """A row of SNAPSHOT: a link that names no repository is an ERROR without a call; a count that isn't a whole number from 0 on is NULL."""
    found = re.search(re.escape(host) + r"/([^/]+)/([^/#?]+)", url)
    api_status, stars = "ERROR", None
    if found:
        status, body, headers, _ = client.ask(f"{api_base.rstrip('/')}/repos/{found.group(1)}/{found.group(2).removesuffix('.git')}", repo_again)
        api_status = {200: "OK", 404: "NOT_FOUND"}.get(status, "RATE_LIMITED" if _limited(status, headers) else "ERROR")
        if api_status == "OK":
            try:
                count = json.loads(body).get("stargazers_count")
                stars = count if isinstance(count, int) and not isinstance(count, bool) and count >= 0 else None
            except (ValueError, AttributeError):
                api_status = "ERROR"
    return url, api_status == "OK", stars, datetime.now(timezone.utc), api_status


def _asked(requests: DataFrame, url: str, at_once: int, row: Callable[[str], tuple], schema: str, name: str) -> DataFrame:
    columns = [c.split()[0] for c in schema.split(", ")]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), _HANDED):
                yield pd.DataFrame([row(u) for u in pdf[name].iloc[k : k + _HANDED]], columns=columns, dtype=object)

    asked = requests.select(F.col(url).alias(name)).where(F.col(name).isNotNull()).repartition(at_once)
    return asked.mapInPandas(rows, schema)


def fetch_pages(requests: DataFrame, url: str = "url", at_once: int = 5, client: Client = Client()) -> DataFrame:
    """(url, http_status, body, content_hash, fetch_status, attempts): one row for each row of requests; at most at_once requests run at a time.

    Rows are spread over at_once tasks and asked for where they are; the driver sees none of them. NULL URLs are left out, one asked
    for twice is fetched twice. A live answer isn't repeatable: store the rows before they are used, and let a failed
    task end the job (spark.task.maxFailures = 1) where a second request must not happen. Headers never leave the client.
    """
    return _asked(requests, url, at_once, lambda u: page_row(client, u), RESPONSE, "url")


def look_up_repositories(requests: DataFrame, url: str = "repo_url", at_once: int = 5, client: Client = Client(timeout=15.0), api_base: str = "https://api.github.com", host: str = "github.com", token: str | None = None) -> DataFrame:
    """Rows of SNAPSHOT, one for each row of requests, as fetch_pages asks: the state of each repository now."""
    headers = {**REPO_HEADERS, **client.headers, **({"Authorization": f"Bearer {token}"} if token else {})}
    asking = Client(**{**client.__dict__, "headers": headers})
    return _asked(requests, url, at_once, lambda u: repo_row(asking, u, api_base, host), SNAPSHOT, "repo_url")
