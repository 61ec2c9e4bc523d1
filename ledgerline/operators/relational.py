"""Table changes and look-ups as set operations: whole tables in, whole tables out, one shuffle on the key at most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """table and rows together, repeated rows kept; columns that rows lack are NULL."""
    return table.unionByName(rows, allowMissingColumns=True)


def absent(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Those of rows whose key table lacks; of rows with one key, one. Rows with a NULL in the key are left out, as a key can't be NULL."""
    return rows.dropna(subset=list(key)).dropDuplicates(list(key)).join(table.select(*key), list(key), "left_anti").select(*rows.columns)


def put_if_absent(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """table and the rows that are absent from it."""
    return append(table, absent(table, rows, key))


def upsert_seen(table: DataFrame, seen: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """table with the sightings (key, at) in: known keys get a later `last` only, new ones a row with both times; other columns of old rows stay.

    Sightings are combined by key before they meet the table. NULL keys are left out.
    """
    sighted = seen.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min("at").alias("__first"), F.max("at").alias("__last"))
    both = table.join(sighted, table[key] == sighted["__key"], "full")
    old = table[key].isNotNull()
    return both.select(
        *(
            F.coalesce(table[c], F.col("__key")).alias(c) if c == key
            else F.coalesce(table[c], F.when(~old, F.col("__first"))).alias(c) if c == first
            else F.greatest(table[c], F.col("__last")).alias(c) if c == last
            else table[c]
            for c in table.columns
        )
    )


def last_writer_wins(table: DataFrame, rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """table with rows in place of those with the same key; of rows with one key the one with the largest `order` (NULL counts least)."""
    latest = latest_by(rows, key, F.col(order), *[F.col(c) for c in rows.columns if dict(rows.dtypes)[c] == "string"][:1])
    return append(table.join(latest.select(*key), list(key), "left_anti").select(*table.columns), latest)


def latest_by(df: DataFrame, key: Sequence[str], order: Column, *tie: Column) -> DataFrame:
    """The row with the largest order of each key (then the largest tie). Spark keeps one row a key and task before the shuffle, so hot keys are no burden."""
    w = Window.partitionBy(*key).orderBy(order.desc_nulls_last(), *(t.desc_nulls_last() for t in tie))
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")


def claim(table: DataFrame, expected: str, new: str, where: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(table with status `new` on rows that had `expected` (and match `where`), those rows as they were)."""
    cond = F.col("status") == expected
    cond = F.coalesce(cond if where is None else cond & where, F.lit(False))
    return table.withColumn("status", F.when(cond, new).otherwise(F.col("status"))), table.where(cond)


def overwrite_fields(table: DataFrame, rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """table with `fields` of rows on the same key, NULLs of rows included; rows has one row a key. Unmatched rows of table stay as they are."""
    new = rows.select(F.col(key).alias("__key"), *(F.col(f).alias(f"__new_{f}") for f in fields))
    hit = F.col("__key").isNotNull()
    return table.join(new, table[key] == new["__key"], "left").select(*(F.when(hit, F.col(f"__new_{c}")).otherwise(table[c]).alias(c) if c in fields else table[c] for c in table.columns))


def set_where(table: DataFrame, cond: Column, **values: Column) -> DataFrame:
    """table with columns set where cond is true (NULL counts as false)."""
    hit = F.coalesce(cond, F.lit(False))
    return table.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def set_for_ids(table: DataFrame, ids: DataFrame, key: str, **values: Column) -> DataFrame:
    """table with columns set on rows whose key is in ids; an empty ids changes nothing."""
    marks = ids.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    joined = table.join(marks, table[key] == marks["__key"], "left")
    return set_where(joined, F.col("__key").isNotNull(), **values).select(*table.columns)


def first_by_status(table: DataFrame, status: str, order: str, tie: str, limit: int) -> DataFrame:
    """The first `limit` rows of a status: a top-k, each task sends `limit` rows at most."""
    return table.where(F.col("status") == status).orderBy(order, tie).limit(limit)


def observations_of_papers(observations: DataFrame, links: DataFrame) -> DataFrame:
    """(asked_paper_id, observation columns): every observation of every paper, linked directly or through links; once even if both.

    Ids are compared in lower case, UUID text. Observations written twice count once.
    """
    low = lambda c: F.lower(F.trim(c))
    direct = observations.select(low("paper_id").alias("asked_paper_id"), low("id").alias("__id")).where(F.col("asked_paper_id").isNotNull())
    shared = links.select(low("paper_id").alias("asked_paper_id"), low("fetch_observation_id").alias("__id")).where(F.col("asked_paper_id").isNotNull())
    once = observations.withColumn("__id", low("id")).dropDuplicates(["__id"])
    return direct.unionByName(shared).distinct().join(once, "__id").drop("__id")


def unverified(papers: DataFrame, links: DataFrame, snapshots: DataFrame, url: Column, any_status: bool = True) -> DataFrame:
    """(paper id, repo_url, first_seen_at) of RESOLVED papers whose selected repository has no snapshot of any status.

    With any_status False only OK and NOT_FOUND snapshots count, so that failed look-ups are made again.

    `url` makes repo_url comparable on both sides. The anti-join needs each repository once: a hot repository's snapshots are combined first.
    """
    told = snapshots if any_status else snapshots.where(F.col("api_status").isin("OK", "NOT_FOUND"))
    known = told.select(url.alias("__url")).where(F.col("__url").isNotNull()).distinct()
    chosen = links.where(F.col("is_selected")).select(F.lower("paper_id").alias("__paper"), "repo_url", url.alias("__url"))
    open_ = papers.where(F.col("status") == "RESOLVED").select("id", F.lower("id").alias("__paper"), "first_seen_at").join(chosen, "__paper")
    return open_.join(known, "__url", "left_anti").select("id", "repo_url", "first_seen_at").distinct()


def ordered_candidates(links: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """links with candidate_no: each paper's candidates from the strongest evidence on, equal ones by id; of all papers, or of those in papers (id).

    Ids of papers are compared in lower case. Rows written twice (same id) count once; NULL strengths come last. Candidates without a paper are
    left out. Each paper's candidates are numbered by themselves: a paper has as many as its page has links.
    """
    asked = links.where(F.col("paper_id").isNotNull()).dropDuplicates(["id"]).withColumn("__paper", F.lower("paper_id"))
    if papers is not None:
        asked = asked.join(papers.select(F.lower("id").alias("__paper")).distinct(), "__paper", "left_semi")
    w = Window.partitionBy("__paper").orderBy(F.col("evidence_strength").asc_nulls_last(), "id")
    return asked.withColumn("candidate_no", F.row_number().over(w)).drop("__paper")


def selected_links(links: DataFrame) -> DataFrame:
    """The selected link of each paper that has one; of several, which the rules forbid, the one with the least id."""
    chosen = links.where(F.col("is_selected") & F.col("paper_id").isNotNull()).withColumn("__paper", F.lower("paper_id"))
    w = Window.partitionBy("__paper").orderBy("id")
    return chosen.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n", "__paper")
