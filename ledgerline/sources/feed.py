"""Feed pages: the plan of pages to fetch, and papers out of feed entries."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import collapse_space, feed_id, feed_time
from ledgerline.operators.nested import flatten_feeds


# How a feed is asked for its newest records first.
ORDER = {"sortBy": "submittedDate", "sortOrder": "descending"}


def page_plan(spark: SparkSession, base: str, max_results: int, page_size: int, query: str = "") -> DataFrame:
    """(start, max_results, source_url, request_url) of each feed page to ask for; the last page isn't cut to max_results.

    request_url carries the search and its order; source_url, under which a page is recorded, only which page it is.
    """
    page = F.concat(F.lit("start="), "id", F.lit(f"&max_results={page_size}"))
    asked = F.concat(F.lit(f"{base}?{urlencode({'search_query': query})}&"), page, F.lit(f"&{urlencode(ORDER)}"))
    return spark.range(0, max_results, page_size, 1).select(F.col("id").alias("start"), F.lit(page_size).alias("max_results"), F.concat(F.lit(f"{base}?"), page).alias("source_url"), asked.alias("request_url"))


def discovered(pages: DataFrame, scope: str, start: str, failed: str, payload: str, entry: str = r"<entry>") -> DataFrame:
    r"""The pages that count: all before the first failed one, up to and with the first one without an entry.

    entry is the pattern that tells an entry; as it stands only a literal "<entry>" does, so a page whose entries have attributes or a
    prefix ends a run. r"<(\w+:)?entry[\s/>]" takes those too.

    Per scope (one discovery run). NULL payloads of pages that didn't fail count as pages without entries. The least stops are found
    by an aggregate and joined back, so no window holds a run's pages.
    """
    stop = F.coalesce(~F.col(payload).rlike(entry), F.lit(True))
    bad = F.coalesce(F.col(failed), F.lit(False))
    ends = pages.groupBy(F.col(scope).alias("__scope")).agg(F.min(F.when(bad, F.col(start))).alias("__fail"), F.min(F.when(~bad & stop, F.col(start))).alias("__last"))
    joined = pages.join(ends, F.col(scope).eqNullSafe(F.col("__scope")))
    keep = ~bad & (F.col("__fail").isNull() | (F.col(start) < F.col("__fail"))) & (F.col("__last").isNull() | (F.col(start) <= F.col("__last")))
    return joined.where(keep).drop("__scope", "__fail", "__last")


def feed_papers(observations: DataFrame, record_id: str, xml: str, url_prefix: str = "https://arxiv.org/abs/", stop_at_v: bool = True) -> tuple[DataFrame, DataFrame]:
    """(papers, rejects) of the entries of feed pages.

    papers: record_id, entry_no, arxiv_id, canonical_url, title, authors, abstract, published_date. rejects: record_id, entry_no, reason,
    in this order: no id, no title, no authors, bad date (a date in another form rejects its entry instead of stopping the run). A blank
    title is no reject. Malformed pages give neither. title and abstract have single spaces; a missing abstract is NULL, a blank one ''.
    """
    flat = flatten_feeds(observations, record_id, xml)
    entries = flat.where(F.col("node") == "entry").select("record_id", F.col("child_no").alias("entry_no"), feed_id(F.col("name"), stop_at_v).alias("arxiv_id"), "title", "published", "body")
    people = flat.where(F.col("node") == "author").groupBy("record_id", F.col("parent_no").alias("entry_no")).agg(F.transform(F.array_sort(F.collect_list(F.struct("child_no", "name"))), lambda a: a["name"]).alias("authors"))
    date = feed_time(F.col("published"))
    judged = entries.join(people, ["record_id", "entry_no"], "left").withColumn(
        "reason",
        F.when(F.col("arxiv_id").isNull() | (F.trim("arxiv_id") == ""), "no id").when(F.col("title").isNull() | (F.col("title") == ""), "no title").when(F.col("authors").isNull(), "no authors").when(F.col("published").isNotNull() & (F.col("published") != "") & date.isNull(), "bad date"),
    )
    papers = judged.where(F.col("reason").isNull()).select(
        "record_id", "entry_no", F.trim("arxiv_id").alias("arxiv_id"), F.concat(F.lit(url_prefix), F.trim("arxiv_id")).alias("canonical_url"), collapse_space(F.col("title")).alias("title"),
        "authors", collapse_space(F.col("body")).alias("abstract"), date.alias("published_date"),
    )
    return papers, judged.where(F.col("reason").isNotNull()).select("record_id", "entry_no", "reason")


def first_of_feed(papers: DataFrame) -> DataFrame:
    """Each paper once, as its first page in order of record_id has it: what was seen first stays."""
    w = Window.partitionBy("arxiv_id").orderBy("record_id", "entry_no")
    return papers.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1).drop("__n")
