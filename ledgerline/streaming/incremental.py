"""Observations as they arrive: each micro-batch's feed pages become papers and lineage in the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.text import record_id
from ledgerline.sources.feed import feed_papers, first_of_feed
from ledgerline.tables import SnapshotStore


def ingest(store: SnapshotStore, batch: DataFrame) -> None:
    """Adds one batch of fetch observations: rows appended, their papers put if absent, their links put if absent.

    All ids come from natural keys and papers and links are put only if absent, so a batch that runs again after a failure changes
    nothing but the observations, which are put by id.
    """
    store.put_if_absent("fetch_observations", batch, ["id"])
    papers, _ = feed_papers(batch, "id", "raw_payload.atom_xml")
    rows = papers.join(batch.select(F.col("id").alias("record_id"), "fetched_at").dropDuplicates(["record_id"]), "record_id")
    paper = record_id(F.lit("paper"), F.col("arxiv_id"))
    known = first_of_feed(papers).join(rows.groupBy("arxiv_id").agg(F.min("fetched_at").alias("at")), "arxiv_id")
    store.put_if_absent(
        "papers",
        known.select(paper.alias("id"), "arxiv_id", "canonical_url", "title", "authors", "abstract", "published_date", F.lit("PARSED").alias("status"), F.lit(None).cast("string").alias("failure_reason"), F.col("at").alias("first_seen_at"), F.col("at").alias("last_seen_at"), F.col("at").alias("updated_at")),
        ["arxiv_id"],
    )
    store.put_if_absent("paper_fetch_observations", rows.select(paper.alias("paper_id"), F.col("record_id").alias("fetch_observation_id"), F.col("fetched_at").alias("linked_at")), ["paper_id", "fetch_observation_id"])


def ingest_stream(store: SnapshotStore, stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Runs ingest on every micro-batch of a stream of fetch observations, until what is there is done."""
    return stream.writeStream.foreachBatch(lambda batch, _: ingest(store, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
