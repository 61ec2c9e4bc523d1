"""Export records out of parsed papers, their selected repository and its latest snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import iso_text, strip_space
from ledgerline.operators.relational import latest_by
from ledgerline.schemas import EXPORT_FIELDS


# Why a record is rejected.
NO_ID, NO_AUTHORS, NO_TITLE = "missing arxiv_id", "no authors", "empty title"
# Why the validation stage fails a paper whose parsed form doesn't hold.
UNPARSED = "ParsedPaper validation failed: "
BLANK_ID, EMPTY_AUTHORS = UNPARSED + "arxiv_id must not be empty", UNPARSED + "authors must not be empty"


def reject_reason(stage: bool = False) -> Column:
    """Why a paper can't be exported, NULL if it can; the checks of the parsed paper come first, in the stage's own words if `stage`."""
    return (
        F.when(F.col("arxiv_id").isNull() | (strip_space(F.col("arxiv_id")) == ""), BLANK_ID if stage else NO_ID)
        .when(F.col("authors").isNull() | (F.size("authors") == 0), EMPTY_AUTHORS if stage else NO_AUTHORS)
        .when(F.col("title").isNull() | (strip_space(F.col("title")) == ""), NO_TITLE)
    )


def build_exports(papers: DataFrame, links: DataFrame, snapshots: DataFrame, url, run_at: str, source_name: str = "arxiv", stage: bool = False) -> tuple[DataFrame, DataFrame]:
    """(exports: paper_id and the export fields, failures: paper_id and reason).

    The four repository fields are filled together, only where the latest snapshot of the selected repository is OK and verified; else they are
    NULL and the record is still good. url(column) makes repository URLs comparable. run_at is the time of the run, so that running
    again gives the same records. stage: reasons in the words of the validation stage (see reject_reason). Only the latest snapshot of each repository takes part in the join, so a hot repository is one row.
    """
    latest = latest_by(snapshots.select(F.explode(F.array(url(F.col("repo_url")))).alias("__url"), "exists_verified", "api_status", "stargazers_count", "stars_fetched_at", F.col("id").alias("__sid")).where(F.col("__url").isNotNull()), ["__url"], F.col("stars_fetched_at"), F.col("__sid"))
    chosen = links.where(F.col("is_selected")).select(F.lower("paper_id").alias("__paper"), "repo_url", F.explode(F.array(url(F.col("repo_url")))).alias("__link_url"), "evidence_type", F.col("id").alias("__lid"))
    one = latest_by(chosen, ["__paper"], F.col("__lid")).drop("__lid")
    # Repositories of links are distinct keys after the first join's side is reduced to one row a paper; the snapshot side has one row a repository.
    repo = one.join(latest, one["__link_url"] == latest["__url"], "left").select(one["__paper"], "repo_url", "evidence_type", "exists_verified", "api_status", "stargazers_count", "stars_fetched_at")
    judged = papers.withColumn("__reason", reject_reason(stage))
    failures = judged.where(F.col("__reason").isNotNull()).select(F.col("id").alias("paper_id"), F.col("__reason").alias("reason"))
    good = judged.where(F.col("__reason").isNull()).join(repo, F.lower("id") == F.col("__paper"), "left")
    told = F.coalesce(F.col("exists_verified") & (F.col("api_status") == "OK"), F.lit(False))
    fields = {
        "schemaVersion": F.lit("1.0"), "recordType": F.lit("RESEARCH_PAPER"), "source_name": F.lit(source_name), "source_url": F.col("canonical_url"), "title": F.col("title"), "authors": F.col("authors"),
        "paper_url": F.col("canonical_url"), "github_url": F.when(told, F.col("repo_url")), "github_stars": F.when(told, F.col("stargazers_count")), "published_date": iso_text(F.col("published_date")),
        "collectedAt": iso_text(F.lit(run_at).cast("timestamp")), "github_stars_fetched_at": F.when(told, iso_text(F.col("stars_fetched_at"))), "github_evidence_type": F.when(told, F.col("evidence_type")),
    }
    return good.select(F.col("id").alias("paper_id"), *(fields[f].alias(f) for f in EXPORT_FIELDS)), failures
