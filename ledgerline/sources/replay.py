"""Data sources for short lists of requests, and the replay of any list from a table of recorded responses. Tables of requests: sources.live."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerline.functions.text import content_hash
from ledgerline.sources.attempts import fold_attempts, page_outcome
from ledgerline.sources.live import REPO_HEADERS, RESPONSE, SNAPSHOT, Client, page_row, repo_row


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class HttpPages(DataSource):
    """spark.read.format("http_pages"): options urls (a JSON list), partitions (requests at once), attempts, base, most, jitter, delay, timeout, headers (JSON).

    An outcome is a row, never an exception: OK; ERROR for answers from 400 on that aren't worth another try; TIMEOUT after the last
    one. A body is NULL and its hash that of no bytes unless the page is OK. `delay` paces the requests of each partition.
    """

    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return RESPONSE

    def reader(self, schema) -> DataSourceReader:
        return _HttpReader(self.options)


class _Reader(DataSourceReader):
    """Options as a client, and a partition for each of the requests that run at once."""

    def __init__(self, options):
        self.urls = json.loads(options.get("urls", "[]"))
        self.parts = max(1, int(options.get("partitions", "1")))
        base, most, jitter = (float(options.get(k, v)) for k, v in (("base", "1"), ("most", "60"), ("jitter", "0.5")))
        self.client = Client(max(1, int(options.get("attempts", "5"))), base, most, jitter, float(options.get("timeout", "20")), float(options.get("delay", "0")), json.loads(options.get("headers", "{}")))

    def partitions(self) -> list[InputPartition]:
        return [_Urls(self.urls[k :: self.parts]) for k in range(min(self.parts, max(1, len(self.urls))))]


class _HttpReader(_Reader):
    def read(self, partition: _Urls) -> Iterator[tuple]:
        for url in partition.urls:
            yield page_row(self.client, url)


class RepoLookups(DataSource):
    """spark.read.format("repo_lookups"): the options of http_pages, urls being repository links; api_base, host, token.

    A row for each link: its state now, as github_repo_snapshots has it. A link that names no repository is an ERROR without a call; a
    count that isn't a whole number from 0 on is NULL. A live lookup isn't repeatable: store its rows, and let a failed task end the job
    (spark.task.maxFailures = 1) if a second call must not happen.
    """

    @classmethod
    def name(cls) -> str:
        return "repo_lookups"

    def schema(self) -> str:
        return SNAPSHOT

    def reader(self, schema) -> DataSourceReader:
        return _RepoReader(self.options)


class _RepoReader(_Reader):
    def __init__(self, options):
        super().__init__(options)
        self.api, self.host = options.get("api_base", "https://api.github.com"), options.get("host", "github.com")
        self.client.headers.update({k: v for k, v in REPO_HEADERS.items() if k not in self.client.headers})
        if options.get("token"):
            self.client.headers["Authorization"] = f"Bearer {options['token']}"

    def read(self, partition: _Urls) -> Iterator[tuple]:
        for url in partition.urls:
            yield repo_row(self.client, url, self.api, self.host)


def replay_pages(requests: DataFrame, recorded: DataFrame, max_attempts: int = 5) -> DataFrame:
    """The rows HttpPages would give for requests (url), from recorded attempts (url, attempt, http_status, body) instead of a network.

    A URL without recorded attempts is a TIMEOUT after max_attempts. A URL asked twice gives two rows. An attempt of NULL http_status
    is one that got no answer.
    """
    ends = fold_attempts(recorded, "url", "attempt", page_outcome(F.col("http_status")), max_attempts)
    good = recorded.join(ends.where(F.col("api_status") == "OK").select("url", F.col("attempts_used").alias("__used")), "url")
    bodies = good.where(F.col("attempt") == F.col("__used")).select("url", "http_status", "body")
    joined = requests.select("url").join(ends.select("url", "attempts_used", "api_status"), "url", "left").join(bodies, "url", "left")
    return joined.select(
        "url", "http_status", "body", content_hash(F.coalesce("body", F.lit(""))).alias("content_hash"), F.coalesce("api_status", F.lit("TIMEOUT")).alias("fetch_status"), F.coalesce("attempts_used", F.lit(max_attempts)).alias("attempts")
    )
