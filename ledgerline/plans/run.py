"""The whole run from the process environment: `python -m ledgerline`."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ledgerline.plans.pipeline import Pipeline, Settings
from ledgerline.session import build_session
from ledgerline.sources.live import Client, fetch_pages, look_up_repositories
from ledgerline.tables import SnapshotStore


@dataclass(frozen=True)
class Environment:
    """What a run is told from outside. Names of variables are those of the fields in capitals; an empty variable counts as none.

    database_url is the folder of the table store; google_service_account_json_path and google_sheets_spreadsheet_id are the folder that the
    sheet is written to and its name.
    """

    # The settings' names and what they are if nothing is said.
    database_url: str
    arxiv_api_base: str = "http://export.arxiv.org/api/query"
    arxiv_request_delay_seconds: float = 3.5
    arxiv_page_size: int = 100
    arxiv_max_results: int = 2000
    arxiv_search_query: str = "cat:cs.AI"
    arxiv_http_timeout_seconds: float = 20.0
    arxiv_abs_max_concurrency: int = 5
    github_token: str | None = None
    github_api_base: str = "https://api.github.com"
    github_max_concurrency: int = 5
    github_http_timeout_seconds: float = 15.0
    gemini_api_key: str | None = None
    cohere_api_key: str | None = None
    groq_api_key: str | None = None
    max_retry_attempts: int = 5
    retry_backoff_base_seconds: float = 1.0
    retry_backoff_max_seconds: float = 60.0
    retry_jitter_seconds: float = 0.5
    google_service_account_json_path: str | None = None
    google_sheets_spreadsheet_id: str | None = None
    sheets_research_papers_tab: str = "Research Papers"
    sheets_batch_size: int = 500
    pipeline_batch_size: int = 50
    log_level: str = "INFO"

    @staticmethod
    def read(values: Mapping[str, str] = os.environ, file: str = ".env") -> Environment:
        """From variables, and where they are missing from NAME=value lines of a file; ValueError for a missing store or a value of the wrong kind."""
        known = {}
        if os.path.exists(file):
            with open(file, encoding="utf-8") as f:
                for line in f:
                    name, eq, value = line.strip().partition("=")
                    if eq and not name.startswith("#"):
                        known[name.strip().upper()] = value.strip().strip("\"'")
        known |= {k.upper(): v for k, v in values.items()}
        given = {}
        for f in fields(Environment):
            value = known.get(f.name.upper(), "")
            if value:
                kind = {"int": int, "float": float}.get(str(f.type), str)
                try:
                    given[f.name] = kind(value)
                except ValueError:
                    raise ValueError(f"{f.name.upper()} isn't a number") from None
        if "database_url" not in given:
            raise ValueError("DATABASE_URL names no store")
        return Environment(**given)

    def client(self, timeout: float, delay: float = 0.0) -> Client:
        return Client(self.max_retry_attempts, self.retry_backoff_base_seconds, self.retry_backoff_max_seconds, self.retry_jitter_seconds, timeout, delay)


def make_pipeline(spark: SparkSession, e: Environment, run_id: str, run_at: str) -> Pipeline:
    """A run over live sources: feed pages one after the other at the asked pace, other requests so many at once."""
    settings = Settings(run_id, run_at, e.arxiv_api_base, e.arxiv_search_query, e.arxiv_page_size, e.arxiv_max_results, sheet_path=e.google_service_account_json_path, sheet_id=e.google_sheets_spreadsheet_id)
    paced, pages, repos = e.client(e.arxiv_http_timeout_seconds, e.arxiv_request_delay_seconds), e.client(e.arxiv_http_timeout_seconds), e.client(e.github_http_timeout_seconds)
    return Pipeline(
        SnapshotStore(spark, e.database_url), settings, lambda urls: fetch_pages(urls, at_once=e.arxiv_abs_max_concurrency, client=pages),
        lambda urls: look_up_repositories(urls, at_once=e.github_max_concurrency, client=repos, api_base=e.github_api_base, token=e.github_token), fetch_feed=lambda urls: fetch_pages(urls, at_once=1, client=paced),
    )


def main() -> None:
    now = datetime.now(timezone.utc)
    # A live answer can't be asked for again: a failed task ends the run, and what was stored stays.
    spark = build_session("ledgerline", spark__task__maxFailures="1")
    e = Environment.read()
    spark.sparkContext.setLogLevel(e.log_level)
    make_pipeline(spark, e, now.strftime("%Y%m%dT%H%M%SZ"), now.strftime("%Y-%m-%d %H:%M:%S")).run()
