"""The whole run: discover, resolve, verify, validate, export - each stage reads tables of the store and publishes new versions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import record_id
from ledgerline.functions.urls import repo_url
from ledgerline.operators import relational as R
from ledgerline.operators.associate import select_primary, selected_twice
from ledgerline.operators.validate import UNPARSED, build_exports
from ledgerline.schemas import EXPORT_FIELDS
from ledgerline.session import cut
from ledgerline.sources.feed import discovered, feed_papers, first_of_feed, page_plan
from ledgerline.sources.log import events
from ledgerline.sources.pages import anchors, link_candidates
from ledgerline.sources.sheet import sheet_rows, write_sheet
from ledgerline.tables import SnapshotStore

#: What asks the outside: urls (url) to responses (url, http_status, body, content_hash, fetch_status), repositories (repo_url) to snapshot rows without id.
Fetch = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Settings:
    """What a run can be told. run_id and run_at make it repeatable: running it again with the same gives the same ids and times."""

    run_id: str
    run_at: str
    feed_base: str = "http://export.arxiv.org/api/query"
    feed_query: str = "cat:cs.AI"
    page_size: int = 100
    max_results: int = 2000
    paper_url: str = "https://arxiv.org/abs/"
    host: str = "github.com"
    source_name: str = "arxiv"
    sheet_path: str | None = None
    sheet_id: str | None = None


class Pipeline:
    def __init__(self, store: SnapshotStore, settings: Settings, fetch_pages: Fetch, look_up: Fetch, fetch_feed: Fetch | None = None):
        """fetch_feed asks for the feed's pages, fetch_pages if there is no other."""
        self.store, self.settings, self.fetch_pages, self.look_up, self.fetch_feed = store, settings, fetch_pages, look_up, fetch_feed or fetch_pages
        self.at = F.lit(settings.run_at).cast("timestamp")

    def _url(self, c: Column) -> Column:
        return repo_url(c, self.settings.host)

    def _log(self, df: DataFrame, stage: str, status: Column, detail: list[str] = (), **fields: Column) -> None:
        self.store.append("pipeline_log", events(df, stage, status, self.settings.run_at, list(detail), source=F.lit(self.settings.source_name), **fields))

    def _observations(self, responses: DataFrame, kind: str, payload: str, paper_id: Column) -> DataFrame:
        """Responses as observations; a failed one keeps an empty payload. Two equal responses of one run to two requests stay two rows."""
        empty = F.lit(None).cast("string")
        body = {"atom_xml": empty, "html": empty, payload: F.when(F.col("fetch_status") == "OK", F.col("body"))}
        return responses.select(
            record_id(F.lit(self.settings.run_id), F.lit(kind), F.col("url")).alias("id"), paper_id.alias("paper_id"), F.lit(self.settings.source_name).alias("source_name"), F.col("url").alias("source_url"),
            F.struct(*(v.alias(k) for k, v in body.items())).alias("raw_payload"), "content_hash", self.at.alias("fetched_at"), "http_status", "fetch_status",
        )

    def discover(self) -> None:
        """Feed pages, their papers and the links between them. Papers already known are only seen again: what was parsed first stays."""
        s = self.settings
        plan = page_plan(self.store.spark, s.feed_base, s.max_results, s.page_size, s.feed_query)
        # All pages of the plan are asked for, a page a row; those past a stop are dropped unread.
        asked = self.fetch_feed(plan.select(F.col("request_url").alias("url"))).join(plan.select(F.col("request_url").alias("url"), "source_url", "start"), "url").drop("url").withColumnRenamed("source_url", "url")
        rows = asked.withColumn("failed", F.col("fetch_status") != "OK").withColumn("run", F.lit(s.run_id))
        responses = cut(discovered(rows, "run", "start", "failed", "body"))
        observed = cut(self._observations(responses, "feed", "atom_xml", F.lit(None).cast("string")))
        self.store.put_if_absent("fetch_observations", observed, ["id"])
        papers, rejects = feed_papers(observed, "id", "raw_payload.atom_xml", s.paper_url)
        papers = cut(papers)
        new_id = record_id(F.lit("paper"), F.col("arxiv_id"))
        known = self.store.read("papers")
        seen = R.upsert_seen(known, papers.select("arxiv_id", self.at.alias("at")), "arxiv_id", "first_seen_at", "last_seen_at")
        fields = ["canonical_url", "title", "authors", "abstract", "published_date"]
        first = first_of_feed(papers).select("arxiv_id", *(F.col(f).alias(f"new_{f}") for f in fields))
        fresh = F.col("id").isNull()
        merged = seen.join(first, "arxiv_id", "left").withColumns({f: F.when(fresh, F.col(f"new_{f}")).otherwise(F.col(f)) for f in fields})
        self.store.publish("papers", merged.withColumns({"status": F.when(fresh, "PARSED").otherwise(F.col("status")), "updated_at": F.when(fresh, self.at).otherwise(F.col("updated_at")), "id": F.coalesce("id", new_id)}))
        ids = self.store.read("papers").select("arxiv_id", F.col("id").alias("paper_id"))
        self.store.put_if_absent("paper_fetch_observations", papers.join(ids, "arxiv_id").select("paper_id", F.col("record_id").alias("fetch_observation_id"), self.at.alias("linked_at")), ["paper_id", "fetch_observation_id"])
        self._log(rejects.select("record_id", "entry_no", "reason"), "discovery_reject", F.lit("SKIPPED"), ["entry_no", "reason"], record_id=F.col("record_id"))

    def resolve(self) -> None:
        """Each PARSED paper's page, the links on it, and the one that is chosen over all links known of the paper."""
        papers = self.store.read("papers")
        open_ = cut(papers.where(F.col("status") == "PARSED").select("id", "canonical_url"))
        responses = self.fetch_pages(open_.select(F.col("canonical_url").alias("url")).distinct()).join(open_.select(F.col("canonical_url").alias("url"), F.col("id").alias("paper")), "url")
        observed = cut(self._observations(responses, "page", "html", F.col("paper")))
        self.store.put_if_absent("fetch_observations", observed, ["id"])
        self._log(observed, "repo_evidence_fetch", F.col("fetch_status"), ["http_status"], record_id=F.col("paper_id"))
        found = link_candidates(anchors(observed.select("paper_id", "source_url", F.col("raw_payload.html").alias("html"), "fetched_at"), "paper_id", "source_url", "html", "fetched_at"), self.settings.host)
        rows = found.withColumnRenamed("page_id", "paper_id").select(record_id(F.lit(self.settings.run_id), F.col("paper_id"), F.col("repo_url")).alias("id"), "*", F.lit(False).alias("is_selected"))
        self.store.put_if_absent("paper_repo_links", rows, ["id"])
        links = self.store.read("paper_repo_links")
        chosen = select_primary(links.join(open_.select(F.col("id").alias("paper_id")), "paper_id", "left_semi"), "paper_id", "id")
        # What was chosen before stays unless another choice is made.
        picks = cut(chosen.where(F.col("selected").isNotNull()).select("paper_id", "selected"))
        marked = links.join(picks, "paper_id", "left").withColumn("is_selected", F.when(F.col("selected").isNotNull(), F.col("id") == F.col("selected")).otherwise(F.col("is_selected"))).drop("selected")
        self.store.publish("paper_repo_links", marked)
        if not selected_twice(self.store.read("paper_repo_links")).isEmpty():
            raise AssertionError("a paper has two selected links")
        done, claimed = R.claim(papers, "PARSED", "RESOLVED")
        self._log(claimed.select("id").join(chosen.select(F.col("paper_id").alias("id"), "n_best", "selected"), "id", "left"), "repo_resolution", F.lit("OK"), ["n_best", "selected"], record_id=F.col("id"))
        self.store.publish("papers", done)

    def verify(self) -> None:
        """A snapshot for each selected repository that has none; each repository is looked up once."""
        waiting = R.unverified(self.store.read("papers"), self.store.read("paper_repo_links"), self.store.read("github_repo_snapshots"), self._url(F.col("repo_url")))
        looked = cut(self.look_up(waiting.select("repo_url").distinct()))
        self.store.put_if_absent("github_repo_snapshots", looked.select(record_id(F.lit(self.settings.run_id), F.col("repo_url")).alias("id"), "*"), ["id"])
        self._log(looked, "github_verification", F.col("api_status"), ["repo_url", "stargazers_count"])

    def validate(self) -> None:
        """RESOLVED papers into records, or FAILED with a reason."""
        papers = self.store.read("papers")
        ready = papers.where(F.col("status") == "RESOLVED")
        good, bad = build_exports(ready, self.store.read("paper_repo_links"), self.store.read("github_repo_snapshots"), self._url, self.settings.run_at, self.settings.source_name, stage=True)
        bad, good = cut(bad), cut(good)
        rows = good.select(
            record_id(F.lit("record"), F.col("paper_id")).alias("id"), "paper_id", F.col("schemaVersion").alias("schema_version"), F.col("recordType").alias("record_type"),
            F.struct(*EXPORT_FIELDS).alias("export_payload"), self.at.alias("validated_at"), F.lit(None).cast("timestamp").alias("exported_at"),
        )
        self.store.replace("validated_records", rows, ["paper_id"], "validated_at")
        reasons = bad.select(F.col("paper_id").alias("id"), "reason")
        failed = papers.join(reasons, "id", "left")
        ready_ = F.col("status") == "RESOLVED"
        self.store.publish("papers", failed.withColumn("failure_reason", F.coalesce("reason", "failure_reason")).withColumn("status", F.when(ready_, F.when(F.col("reason").isNotNull(), "FAILED").otherwise("VALIDATED")).otherwise(F.col("status"))))
        kind = F.when(F.col("reason").startswith(UNPARSED), "ParsedPaperValidationError").otherwise("PaperValidationError")
        self._log(bad, "validate", F.lit("FAILED"), ["reason"], record_id=F.col("paper_id"), error_type=kind)
        self._log(good.select("paper_id"), "validate", F.lit("OK"), record_id=F.col("paper_id"))

    def export(self) -> None:
        """The sheet of all records anew; what was written is marked, from the same reading of the table."""
        records = self.store.read("validated_records")
        rows = sheet_rows(records.select("validated_at", "paper_id", "export_payload.*")).orderBy("validated_at", "paper_id").select(*EXPORT_FIELDS)
        write_sheet(rows, self.settings.sheet_path, self.settings.sheet_id)
        self.store.publish("validated_records", R.set_where(records, F.col("exported_at").isNull(), exported_at=self.at))
        self._log(records.agg(F.count(F.lit(1)).alias("rows_exported")), "export", F.lit("OK"), ["rows_exported"])

    def run(self) -> None:
        self.store.migrate()
        for stage in (self.discover, self.resolve, self.verify, self.validate, self.export):
            stage()
