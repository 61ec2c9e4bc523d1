"""Queries of the evidence operators, each over its whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import collapse_space, content_hash, feed_id, feed_time, iso_text
from ledgerline.functions.urls import RESERVED_OWNERS, owner_and_repo, repo_url
from ledgerline.grounding.checks import BAD_CLAIM_QUOTE, BAD_QUOTE, EXTRACTION, NO_CLAIM, NO_QUOTE, NO_VALUE, decode, ground
from ledgerline.grounding.pipeline import route
from ledgerline.operators import relational as R
from ledgerline.operators.associate import mark_selected, select_primary, selected_twice
from ledgerline.operators.skew import lookup
from ledgerline.operators.validate import build_exports, reject_reason
from ledgerline.plans.core_queries import AUTHORS_SQL, FEEDS_SQL, _url, xml_text
from ledgerline.schemas import EXPORT_FIELDS, evidence_strength, key_violations, violation
from ledgerline.session import shared_folder, table
from ledgerline.sources.attempts import backoff, fold_attempts, provider_wait, repo_outcome
from ledgerline.sources.feed import discovered, feed_papers, page_plan
from ledgerline.sources.log import events
from ledgerline.sources.pages import anchors, link_candidates
from ledgerline.sources.replay import replay_pages
from ledgerline.sources.sheet import chunked, read_sheet, sheet_rows, write_sheet
from ledgerline.tables import SnapshotStore

HOST = "codeforge.example"
#: The time of the run that queries write; fixed, so that they give the same rows each time.
RUN_AT = "2025-03-01 00:00:00"
#: The moment that splits a table into what was there and what came later, where a query needs both.
SPLIT = "2025-01-20 00:00:00"

#: A moment at which most repositories had no snapshot yet.
EARLY = "2025-01-02 00:00:00"

SQL: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _collapsed(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '{_SPACES}', ' ', 'g'), '^ | $', '', 'g')"


def _canonical(c: Column) -> Column:
    return repo_url(c, HOST, reserved=())


def _once(df: DataFrame) -> DataFrame:
    return df.dropDuplicates(["id"])


# Sources


# Links of article pages as text, for what the tables hold: a container runs to its own end tag, or to the end of a cut page.
_SHOWN = r"regexp_replace({0}, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"
_ANCHOR = r"""(?s)<a [^>]*href="[^"]*"[^>]*>.*?(?:</a>|$)"""
_HREF = """replace(regexp_extract(a, 'href="([^"]*)"', 1), '&amp;', '&')"""


def _boxes(order: int, tag: str, classes: str) -> str:
    return rf"""SELECT id, {order} AS o, unnest(regexp_extract_all(h, '(?s)<{tag} class="{classes}">(.*?)(?:</{tag}>|$)', 1)) AS box, '{tag}.{classes.replace(" ", ".")}' AS name FROM pages"""


_LINKS = f"""
WITH pages AS (SELECT DISTINCT id, {_SHOWN.format("raw_payload.html")} AS h FROM fetch_observations WHERE raw_payload.html IS NOT NULL),
boxes AS ({_boxes(0, "blockquote", "abstract")} UNION ALL {_boxes(1, "td", "tablecell comments")} UNION ALL {_boxes(2, "td", "tablecell jref")}),
anchors AS (SELECT id, o, name, regexp_extract_all(box, '{_ANCHOR}') AS all_ FROM boxes),
links AS (SELECT id, o, name, unnest(all_) AS a, unnest(range(len(all_))) AS n FROM anchors),
found AS (SELECT id AS page_id, o, n, name, {_url(_HREF)} AS repo_url, nullif(trim(regexp_replace(a, '<[^>]*>', '', 'g')), '') AS text FROM links),
first AS (SELECT DISTINCT ON (page_id, repo_url) * FROM found WHERE repo_url IS NOT NULL ORDER BY page_id, repo_url, o, n),
candidates AS (SELECT page_id, repo_url, '<a> in ' || name || coalesce(', text=' || chr(39) || text || chr(39), '') AS evidence_locator, text AS evidence_text FROM first)"""


@query(f"""{_LINKS}, c AS (SELECT page_id, count(*) AS n_best, count(*) FILTER (WHERE contains(lower(evidence_locator), 'official')) AS n_official, min(repo_url) AS one, min(repo_url) FILTER (WHERE contains(lower(evidence_locator), 'official')) AS official FROM candidates GROUP BY 1)
SELECT page_id, n_best, n_official, CASE WHEN n_best = 1 THEN one WHEN n_official = 1 THEN official END AS repo_url FROM c""")
def selected_repository(spark: SparkSession, d: str) -> DataFrame:
    """Links in the containers of article pages, and the repository chosen for each page."""
    pages = table(spark, d, "fetch_observations").select("id", "source_url", F.col("raw_payload.html").alias("html"), "fetched_at")
    candidates = link_candidates(anchors(pages, "id", "source_url", "html", "fetched_at"), HOST, ())
    chosen = select_primary(candidates, "page_id", "repo_url")
    return chosen.select("page_id", "n_best", "n_official", F.col("selected").alias("repo_url"))


@query(f"{_LINKS} SELECT * FROM candidates")
def extract_links(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "fetch_observations").select("id", "source_url", F.col("raw_payload.html").alias("html"), "fetched_at")
    return link_candidates(anchors(pages, "id", "source_url", "html", "fetched_at"), HOST, ()).select("page_id", "repo_url", "evidence_locator", "evidence_text")


_JUDGED = f"""
WITH {FEEDS_SQL}, {AUTHORS_SQL}, names AS (SELECT record_id, entry_no, string_agg(name, '; ' ORDER BY author_no) AS authors FROM authors GROUP BY ALL),
parts AS (SELECT record_id, entry_no, authors, nullif(trim(regexp_extract({xml_text("e", "id")}, 'abs/([^v]+)', 1)), '') AS arxiv_id, {xml_text("e", "title")} AS title, {xml_text("e", "summary")} AS summary, nullif({xml_text("e", "published")}, '') AS published
          FROM entries LEFT JOIN names USING (record_id, entry_no)),
judged AS (SELECT *, try_strptime(published, '%Y-%m-%dT%H:%M:%SZ') AT TIME ZONE 'UTC' AS day FROM parts),
told AS (SELECT *, CASE WHEN arxiv_id IS NULL THEN 'no id' WHEN coalesce(title, '') = '' THEN 'no title' WHEN authors IS NULL THEN 'no authors' WHEN published IS NOT NULL AND day IS NULL THEN 'bad date' END AS reason FROM judged)"""


@query(f"{_JUDGED} SELECT record_id, entry_no, arxiv_id, 'https://paperhub.example/abs/' || arxiv_id AS canonical_url, {_collapsed('title')} AS title, authors, {_collapsed('summary')} AS abstract, day AS published_date FROM told WHERE reason IS NULL")
def feed_records(spark: SparkSession, d: str) -> DataFrame:
    papers, _ = feed_papers(table(spark, d, "fetch_observations"), "id", "raw_payload.atom_xml", "https://paperhub.example/abs/")
    return papers.withColumn("authors", F.array_join("authors", "; "))


@query(f"{_JUDGED} SELECT record_id, entry_no, reason FROM told WHERE reason IS NOT NULL")
def feed_rejects(spark: SparkSession, d: str) -> DataFrame:
    return feed_papers(table(spark, d, "fetch_observations"), "id", "raw_payload.atom_xml")[1]


@query("""SELECT range AS start, 100 AS max_results, 'https://feed.example/query?start=' || range || '&max_results=100' AS source_url,
'https://feed.example/query?search_query=cat%3Acs.AI&start=' || range || '&max_results=100&sortBy=submittedDate&sortOrder=descending' AS request_url FROM range(0, (SELECT count(*) FROM papers), 100)""")
def feed_page_plan(spark: SparkSession, d: str) -> DataFrame:
    """Requests for as many records as papers has."""
    return page_plan(spark, "https://feed.example/query", table(spark, d, "papers").count(), 100, "cat:cs.AI")


@query("""
WITH pages AS (
  SELECT DISTINCT id, strftime(fetched_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS run, regexp_extract(source_url, 'start=([0-9]+)', 1)::BIGINT AS start, fetch_status <> 'OK' AS failed,
         contains(raw_payload.atom_xml, '<entry>') AS has FROM fetch_observations WHERE regexp_matches(source_url, 'start=[0-9]+')),
ends AS (SELECT run, min(CASE WHEN failed THEN start END) AS f, min(CASE WHEN NOT failed AND NOT coalesce(has, false) THEN start END) AS l FROM pages GROUP BY run)
SELECT id, run, start FROM pages JOIN ends USING (run) WHERE NOT failed AND (f IS NULL OR start < f) AND (l IS NULL OR start <= l)""")
def discovered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Each day's feed pages as one discovery run, up to its first failure or page without entries."""
    start = F.regexp_extract("source_url", "start=([0-9]+)", 1)
    rows = table(spark, d, "fetch_observations").where(start != "").select(
        "id", F.date_format("fetched_at", "yyyy-MM-dd").alias("run"), start.cast("bigint").alias("start"), (F.col("fetch_status") != "OK").alias("failed"),
        F.when(F.contains("raw_payload.atom_xml", F.lit("<entry>")), "<entry>").alias("body"),
    )
    return discovered(rows.distinct(), "run", "start", "failed", "body").select("id", "run", "start")


# Half of the limited readings stand for a 429, the others for a 403 with or without requests left, by the first digit of the row's id.
_CODE = "CASE api_status WHEN 'OK' THEN 200 WHEN 'NOT_FOUND' THEN 404 WHEN 'RATE_LIMITED' THEN CASE WHEN lower(id) < '8' THEN 429 ELSE 403 END ELSE 500 END"


@query(f"""
WITH log AS (SELECT DISTINCT id, {_url("repo_url")} AS k, stars_fetched_at AS t, {_CODE} AS code FROM github_repo_snapshots),
o AS (SELECT *, CASE WHEN code = 200 THEN 'OK' WHEN code = 404 THEN 'NOT_FOUND' WHEN code = 429 OR code = 403 AND lower(id) < 'c' THEN 'retry:RATE_LIMITED' WHEN code = 403 THEN 'ERROR' ELSE 'retry:ERROR' END AS o FROM log WHERE k IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, o) AS n FROM o QUALIFY n <= 5),
e AS (SELECT k, coalesce(min(CASE WHEN o NOT LIKE 'retry:%' THEN n END), max(n)) AS used FROM r GROUP BY k)
SELECT k AS repo_url, used::INT AS attempts_used, replace(o, 'retry:', '') AS api_status, ((1 << (used - 1)::INT) - 1)::DOUBLE AS waited FROM e JOIN r USING (k) WHERE n = used""")
def retry_fold(spark: SparkSession, d: str) -> DataFrame:
    """Each repository's readings as a log of attempts: the first final one of five, and the time waited."""
    limited = F.when(F.lower("id") < "8", 429).otherwise(403)
    log = _once(table(spark, d, "github_repo_snapshots")).select(
        F.explode(F.array(_canonical(F.col("repo_url")))).alias("repo_url"), "stars_fetched_at", F.when(F.lower("id") < "c", "0").otherwise("5").alias("remaining"),
        F.when(F.col("api_status") == "OK", 200).when(F.col("api_status") == "NOT_FOUND", 404).when(F.col("api_status") == "RATE_LIMITED", limited).otherwise(500).alias("code"),
    )
    return fold_attempts(log, "repo_url", "stars_fetched_at", repo_outcome(F.col("code"), F.col("remaining")))


_TRIES = "SELECT id, http_status AS status, row_number() OVER (PARTITION BY source_url ORDER BY fetched_at, id) AS attempt FROM (SELECT DISTINCT id, source_url, fetched_at, http_status FROM fetch_observations)"


def _tries(spark: SparkSession, d: str) -> DataFrame:
    """Each fetch with its place among those of its URL, as if they were attempts of one request."""
    once = table(spark, d, "fetch_observations").select("id", "source_url", "fetched_at", "http_status").distinct()
    return once.select("id", F.col("http_status").alias("status"), F.row_number().over(Window.partitionBy("source_url").orderBy("fetched_at", "id")).cast("bigint").alias("attempt"))


@query(f"SELECT id, attempt, least(pow(2, least(attempt, 20) - 1), 60.0)::DOUBLE AS seconds FROM ({_TRIES})")
def backoff_plan(spark: SparkSession, d: str) -> DataFrame:
    """The wait after each fetch of a URL, if they were attempts of one request."""
    return _tries(spark, d).select("id", "attempt", backoff(F.col("attempt").cast("double")).alias("seconds"))


@query(f"""
WITH h AS (SELECT id, attempt, CASE WHEN lower(id) < '4' THEN 429 WHEN lower(id) < '8' THEN 503 ELSE coalesce(status, 500) END AS status, CASE WHEN lower(id) < '1' THEN '7' WHEN lower(id) < '2' THEN 'soon' END AS retry_after FROM ({_TRIES}))
SELECT *, CASE WHEN status = 429 THEN least(CASE WHEN retry_after IS NULL THEN pow(2, least(attempt, 20) - 1) WHEN retry_after = '7' THEN 7 ELSE 2 END, 30)
WHEN status >= 500 THEN least(pow(2, least(attempt, 20) - 1), 10) END::DOUBLE AS seconds FROM h""")
def provider_backoff(spark: SparkSession, d: str) -> DataFrame:
    """Waits of an extraction provider by status, attempt and what the server asks for; statuses and headers by the first digit of the row's id."""
    i = F.lower("id")
    plan = _tries(spark, d).select(
        "id", "attempt", F.when(i < "4", 429).when(i < "8", 503).otherwise(F.coalesce("status", F.lit(500))).alias("status"), F.when(i < "1", "7").when(i < "2", "soon").alias("retry_after")
    )
    return plan.withColumn("seconds", provider_wait(F.col("status"), F.col("attempt").cast("double"), F.col("retry_after")))


@query(f"""
WITH t AS (SELECT t.*, o.source_url, coalesce(o.raw_payload.atom_xml, o.raw_payload.html) AS body FROM ({_TRIES}) t JOIN (SELECT DISTINCT ON (id) * FROM fetch_observations) o USING (id)),
k AS (SELECT *, CASE WHEN status IS NULL THEN 'retry' WHEN status >= 400 THEN 'ERROR' ELSE 'OK' END AS o FROM t WHERE attempt <= 5),
e AS (SELECT source_url, coalesce(min(attempt) FILTER (WHERE o <> 'retry'), max(attempt)) AS used FROM k GROUP BY 1)
SELECT e.source_url AS url, used::INT AS attempts, CASE WHEN o = 'retry' THEN 'TIMEOUT' ELSE o END AS fetch_status, CASE WHEN o = 'OK' THEN status END AS http_status,
       sha256(CASE WHEN o = 'OK' THEN coalesce(body, '') ELSE '' END) AS content_hash FROM e JOIN k ON e.source_url = k.source_url AND used = attempt""")
def replayed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every URL asked for again, answered from its recorded fetches."""
    rows = _once(table(spark, d, "fetch_observations")).select("id", F.col("source_url").alias("url"), F.coalesce("raw_payload.atom_xml", "raw_payload.html").alias("body"))
    recorded = rows.join(_tries(spark, d), "id").select("url", "attempt", F.col("status").alias("http_status"), "body")
    return replay_pages(rows.select("url").distinct(), recorded).select("url", "attempts", "fetch_status", "http_status", "content_hash")


_RESERVED = ", ".join(f"'{o}'" for o in RESERVED_OWNERS)
_OWNED = f"SELECT DISTINCT 'https://codeforge.example/' || CASE WHEN length(title) % 2 = 0 THEN list_extract([{_RESERVED}], 1 + length(title) % {len(RESERVED_OWNERS)}) ELSE 'o' || length(title) END || '/' || length(abstract) AS url FROM papers WHERE title IS NOT NULL AND abstract IS NOT NULL"


@query(f"SELECT url, CASE WHEN regexp_extract(url, 'example/([^/]+)', 1) NOT IN ({_RESERVED}) THEN url END AS repo_url FROM ({_OWNED})")
def reserved_owners(spark: SparkSession, d: str) -> DataFrame:
    """Links of papers' lengths, half of them below names that the host keeps for itself, which are no repositories."""
    n = F.length("title")
    owner = F.when(n % 2 == 0, F.element_at(F.array(*map(F.lit, RESERVED_OWNERS)), 1 + n % len(RESERVED_OWNERS))).otherwise(F.concat(F.lit("o"), n))
    urls = table(spark, d, "papers").where(F.col("title").isNotNull() & F.col("abstract").isNotNull()).select(F.concat(F.lit(f"https://{HOST}/"), owner, F.lit("/"), F.length("abstract")).alias("url")).distinct()
    return urls.select("url", repo_url(F.col("url"), HOST).alias("repo_url"))


@query(f"SELECT DISTINCT repo_url AS url, {_url('repo_url')} AS repo_url FROM paper_repo_links")
def normalize_repo_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "paper_repo_links").select(F.col("repo_url").alias("url")).distinct().select("url", _canonical(F.col("url")).alias("repo_url"))


@query(r"""SELECT DISTINCT repo_url AS url, nullif(regexp_extract(repo_url, 'codeforge\.example/([^/]+)/([^/#?]+)', 1), '') AS owner,
nullif(regexp_replace(regexp_extract(repo_url, 'codeforge\.example/([^/]+)/([^/#?]+)', 2), '\.git$', ''), '') AS repo FROM github_repo_snapshots""")
def lookup_owner_repo(spark: SparkSession, d: str) -> DataFrame:
    owner, repo = owner_and_repo(F.col("url"), HOST)
    return table(spark, d, "github_repo_snapshots").select(F.col("repo_url").alias("url")).distinct().select("url", owner.alias("owner"), repo.alias("repo"))


@query("SELECT DISTINCT canonical_url, nullif(regexp_extract(canonical_url, 'abs/([^v]+)', 1), '') AS record FROM papers")
def feed_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers").select("canonical_url", feed_id(F.col("canonical_url")).alias("record")).distinct()


@query(rf"""SELECT id, regexp_replace(regexp_replace(title, '{_SPACES}', ' ', 'g'), '^ | $', '', 'g') AS title,
regexp_replace(regexp_replace(abstract, '{_SPACES}', ' ', 'g'), '^ | $', '', 'g') AS abstract FROM papers""")
def whitespace_collapse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers").select("id", collapse_space(F.col("title")).alias("title"), collapse_space(F.col("abstract")).alias("abstract"))


@query("SELECT DISTINCT id, sha256(coalesce(raw_payload.atom_xml, raw_payload.html, '')) AS sha, sha256(coalesce(raw_payload.atom_xml, raw_payload.html, '')) = content_hash AS same FROM fetch_observations")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    sha = content_hash(F.coalesce("raw_payload.atom_xml", "raw_payload.html", F.lit("")))
    return table(spark, d, "fetch_observations").select("id", sha.alias("sha"), "content_hash").distinct().select("id", "sha", (F.col("sha") == F.col("content_hash")).alias("same"))


@query("""SELECT id, strftime(published_date AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS text, epoch_us(published_date) AS us,
replace(strftime(first_seen_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f+00:00'), '.000000+', '+') AS seen FROM papers""")
def feed_times(spark: SparkSession, d: str) -> DataFrame:
    """Times to feed text and back, and to ISO text."""
    text = F.date_format("published_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "papers").select("id", text.alias("text"), F.unix_micros(feed_time(text)).alias("us"), iso_text(F.col("first_seen_at")).alias("seen"))


# Tables


@query("SELECT id, count(*) AS n_rows FROM (SELECT id FROM github_repo_snapshots UNION ALL SELECT id FROM github_repo_snapshots WHERE api_status = 'OK') GROUP BY id")
def append_rows(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "github_repo_snapshots")
    return R.append(t, t.where("api_status = 'OK'")).groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT DISTINCT paper_id, fetch_observation_id FROM paper_fetch_observations WHERE paper_id IS NOT NULL AND fetch_observation_id IS NOT NULL")
def link_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Old links, then all links put if absent, twice."""
    links = table(spark, d, "paper_fetch_observations").select("paper_id", "fetch_observation_id", "linked_at")
    key = ["paper_id", "fetch_observation_id"]
    once = R.put_if_absent(links.where(F.col("linked_at") < SPLIT), links, key)
    return R.put_if_absent(once, links, key).select(*key)


@query("""
WITH o AS (SELECT DISTINCT ON (lower(trim(id))) lower(trim(id)) AS oid, id, paper_id, fetched_at FROM fetch_observations ORDER BY lower(trim(id))),
asked AS (
  SELECT lower(trim(paper_id)) AS p, lower(trim(id)) AS oid FROM fetch_observations WHERE paper_id IS NOT NULL
  UNION SELECT lower(trim(paper_id)), lower(trim(fetch_observation_id)) FROM paper_fetch_observations WHERE paper_id IS NOT NULL)
SELECT p AS asked_paper_id, id AS observation_id, fetched_at FROM asked JOIN o USING (oid)""")
def lineage(spark: SparkSession, d: str) -> DataFrame:
    """Every observation of every paper, linked directly or through the link table."""
    slim = table(spark, d, "fetch_observations").select("id", "paper_id", "fetched_at")
    return R.observations_of_papers(slim, table(spark, d, "paper_fetch_observations")).select("asked_paper_id", F.col("id").alias("observation_id"), "fetched_at")


@query(f"""
WITH seen AS (SELECT regexp_extract(source_url, 'abs/([^v?]+)', 1) AS k, min(fetched_at) AS f, max(fetched_at) AS l FROM fetch_observations WHERE raw_payload.html IS NOT NULL GROUP BY 1),
known AS (SELECT arxiv_id, first_seen_at, last_seen_at FROM papers WHERE first_seen_at < TIMESTAMPTZ '{SPLIT}+00')
SELECT coalesce(arxiv_id, k) AS arxiv_id, coalesce(first_seen_at, f) AS first_seen_at, greatest(last_seen_at, l) AS last_seen_at
FROM known FULL JOIN (SELECT * FROM seen WHERE k <> '') ON arxiv_id = k""")
def upsert_seen(spark: SparkSession, d: str) -> DataFrame:
    """Papers known at a moment, then every page seen."""
    known = table(spark, d, "papers").where(F.col("first_seen_at") < F.lit(SPLIT).cast("timestamp")).select("arxiv_id", "first_seen_at", "last_seen_at")
    pages = table(spark, d, "fetch_observations").where(F.col("raw_payload.html").isNotNull())
    seen = pages.select(F.nullif(F.regexp_extract("source_url", "abs/([^v?]+)", 1), F.lit("")).alias("arxiv_id"), F.col("fetched_at").alias("at"))
    return R.upsert_seen(known, seen, "arxiv_id", "first_seen_at", "last_seen_at")


@query("SELECT id, CASE WHEN status = 'PARSED' THEN 'RESOLVING_REPO' ELSE status END AS status, coalesce(status = 'PARSED', false) AS claimed FROM papers")
def claim_status(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "papers").select("id", "status")
    after, claimed = R.claim(papers, "PARSED", "RESOLVING_REPO")
    return after.join(claimed.select("id", F.lit(True).alias("c")), "id", "left").select("id", "status", F.coalesce("c", F.lit(False)).alias("claimed"))


_LATEST_RECORD = "SELECT DISTINCT ON (lower(paper_id)) lower(paper_id) AS k, export_payload.title AS title, export_payload.authors AS authors, export_payload.paper_url AS url, export_payload.published_date::TIMESTAMPTZ AS at, validated_at FROM validated_records WHERE paper_id IS NOT NULL ORDER BY lower(paper_id), validated_at DESC, id DESC"


@query(f"""SELECT p.id, abstract, CASE WHEN v.k IS NOT NULL THEN v.title ELSE p.title END AS title, array_to_string(CASE WHEN v.k IS NOT NULL THEN v.authors ELSE p.authors END, '; ') AS authors, CASE WHEN v.k IS NOT NULL THEN v.url ELSE canonical_url END AS canonical_url,
CASE WHEN v.k IS NOT NULL THEN v.at ELSE published_date END AS published_date, CASE WHEN v.k IS NOT NULL THEN 'PARSED' ELSE status END AS status FROM papers p LEFT JOIN ({_LATEST_RECORD}) v ON lower(p.id) = v.k""")
def mark_parsed(spark: SparkSession, d: str) -> DataFrame:
    """Papers' parsed fields overwritten, by NULLs too, by those of their latest record; those are PARSED then."""
    payload = {"title": F.col("export_payload.title"), "authors": F.col("export_payload.authors"), "canonical_url": F.col("export_payload.paper_url"), "published_date": F.to_timestamp("export_payload.published_date"), "status": F.lit("PARSED")}
    records = table(spark, d, "validated_records").where(F.col("paper_id").isNotNull()).select(F.lower("paper_id").alias("k"), *(c.alias(n) for n, c in payload.items()), "validated_at", "id")
    latest = R.latest_by(records, ["k"], F.col("validated_at"), F.col("id")).drop("validated_at", "id")
    papers = table(spark, d, "papers").select("id", "abstract", *payload, F.lower("id").alias("k"))
    return R.overwrite_fields(papers, latest, "k", list(payload)).drop("k").withColumn("authors", F.array_join("authors", "; "))


@query("SELECT id, CASE WHEN title IS NULL OR trim(title) = '' THEN 'FAILED' ELSE status END AS status, CASE WHEN title IS NULL OR trim(title) = '' THEN 'empty title' ELSE failure_reason END AS failure_reason FROM papers")
def mark_failed(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "papers").select("id", "title", "status", "failure_reason")
    empty = F.col("title").isNull() | (F.trim("title") == "")
    return R.set_where(papers, empty, status=F.lit("FAILED"), failure_reason=F.lit("empty title")).drop("title")


@query("SELECT id, first_seen_at FROM papers WHERE status = 'RESOLVED' ORDER BY first_seen_at, id LIMIT 50")
def first_by_status(spark: SparkSession, d: str) -> DataFrame:
    return R.first_by_status(table(spark, d, "papers").select("id", "status", "first_seen_at"), "RESOLVED", "first_seen_at", "id", 50).select("id", "first_seen_at")


@query("SELECT id, arxiv_id, title FROM papers WHERE lower(id) = (SELECT min(lower(id)) FROM papers)")
def paper_lookup(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "papers")
    key = papers.agg(F.min(F.lower("id")).alias("k")).select("k").scalar()
    return papers.where(F.lower("id") == key).select("id", "arxiv_id", "title")


@query("SELECT DISTINCT id, paper_id, evidence_type, CASE evidence_type WHEN 'authoritative_paper_page' THEN 1 WHEN 'trusted_metadata' THEN 2 WHEN 'pwc_verified' THEN 3 WHEN 'pwc_ai_agent_parsed' THEN 4 END AS strength FROM paper_repo_links")
def link_strength(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "paper_repo_links").select("id", "paper_id", "evidence_type", evidence_strength(F.col("evidence_type")).alias("strength")).distinct()


_BEST = """
l AS (SELECT DISTINCT id, lower(paper_id) AS paper_id, evidence_strength AS s, coalesce(contains(lower(evidence_locator), 'official'), false) AS o FROM paper_repo_links WHERE paper_id IS NOT NULL),
b AS (SELECT paper_id, min(s) AS s FROM l GROUP BY 1),
c AS (SELECT paper_id, count(*) AS n_best, count(*) FILTER (WHERE o) AS n_official, min(id) AS only_id, min(id) FILTER (WHERE o) AS official_id FROM l JOIN b USING (paper_id, s) GROUP BY 1),
chosen AS (SELECT paper_id, n_best, n_official, CASE WHEN n_best = 1 THEN only_id WHEN n_official = 1 THEN official_id END AS selected FROM c)"""


def _chosen(spark: SparkSession, d: str) -> DataFrame:
    links = _once(table(spark, d, "paper_repo_links")).withColumn("paper_id", F.lower("paper_id"))
    return select_primary(links, "paper_id", "id")


@query(f"WITH {_BEST} SELECT * FROM chosen")
def select_primary_link(spark: SparkSession, d: str) -> DataFrame:
    return _chosen(spark, d)


@query(f"WITH {_BEST} SELECT DISTINCT l.id, l.id IN (SELECT selected FROM chosen WHERE selected IS NOT NULL) AS is_selected FROM paper_repo_links l")
def mark_selected_link(spark: SparkSession, d: str) -> DataFrame:
    return mark_selected(_once(table(spark, d, "paper_repo_links").select("id", "paper_id")), _chosen(spark, d)).select("id", "is_selected")


@query("SELECT lower(paper_id) AS paper_id, count(DISTINCT id) AS n FROM paper_repo_links WHERE is_selected OR evidence_strength = 1 GROUP BY 1 HAVING count(DISTINCT id) > 1")
def links_selected_twice(spark: SparkSession, d: str) -> DataFrame:
    """The rule of one selected link, held against a selection of all of the strongest kind."""
    links = table(spark, d, "paper_repo_links").select("id", F.lower("paper_id").alias("paper_id"), (F.col("is_selected") | (F.col("evidence_strength") == 1)).alias("is_selected"))
    return selected_twice(links)


@query("SELECT id, lower(paper_id) AS paper_id, evidence_strength, row_number() OVER (PARTITION BY lower(paper_id) ORDER BY evidence_strength, id) AS candidate_no FROM (SELECT DISTINCT id, paper_id, evidence_strength FROM paper_repo_links WHERE paper_id IS NOT NULL)")
def ordered_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Each paper's candidates, the strongest evidence first."""
    return R.ordered_candidates(table(spark, d, "paper_repo_links").select("id", "paper_id", "evidence_strength")).withColumn("paper_id", F.lower("paper_id"))


@query("SELECT lower(paper_id) AS paper_id, min(id) AS id, arg_min(repo_url, id) AS repo_url, arg_min(evidence_type, id) AS evidence_type FROM paper_repo_links WHERE is_selected AND paper_id IS NOT NULL GROUP BY 1")
def selected_link(spark: SparkSession, d: str) -> DataFrame:
    return R.selected_links(table(spark, d, "paper_repo_links").select("id", "paper_id", "repo_url", "evidence_type", "is_selected")).select(F.lower("paper_id").alias("paper_id"), "id", "repo_url", "evidence_type")


@query("SELECT id, evidence_strength, is_selected, count(*) AS n_rows FROM (SELECT id, evidence_type, is_selected, evidence_strength FROM paper_repo_links UNION ALL SELECT id, evidence_type, NULL, NULL FROM paper_repo_links) GROUP BY ALL")
def append_links(spark: SparkSession, d: str) -> DataFrame:
    """Candidates appended again without their strength and mark, which are NULL then; nothing is deduplicated."""
    links = table(spark, d, "paper_repo_links").select("id", "evidence_type", "is_selected", "evidence_strength")
    return R.append(links, links.select("id", "evidence_type")).groupBy("id", "evidence_strength", "is_selected").agg(F.count(F.lit(1)).alias("n_rows"))


_LATEST = f"SELECT DISTINCT ON (k) k, id, api_status, exists_verified, stargazers_count, stars_fetched_at FROM (SELECT *, {_url('repo_url')} AS k FROM github_repo_snapshots) WHERE k IS NOT NULL ORDER BY k, stars_fetched_at DESC, id DESC"


@query(f"SELECT k AS repo_url, id, api_status, stargazers_count, stars_fetched_at FROM ({_LATEST})")
def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "github_repo_snapshots").select(F.explode(F.array(_canonical(F.col("repo_url")))).alias("repo_url"), "id", "api_status", "stargazers_count", "stars_fetched_at")
    return R.latest_by(rows.where(F.col("repo_url").isNotNull()), ["repo_url"], F.col("stars_fetched_at"), F.col("id"))


@query(f"""
SELECT DISTINCT p.id, l.repo_url, p.first_seen_at FROM papers p JOIN paper_repo_links l ON lower(p.id) = lower(l.paper_id) AND l.is_selected
WHERE p.status = 'RESOLVED' AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT {_url("repo_url")} AS k FROM github_repo_snapshots WHERE stars_fetched_at < TIMESTAMPTZ '{EARLY}+00') s WHERE s.k = {_url("l.repo_url")})""")
def unverified_repositories(spark: SparkSession, d: str) -> DataFrame:
    """What was still to be looked up at an early moment."""
    snapshots = table(spark, d, "github_repo_snapshots").where(F.col("stars_fetched_at") < F.lit(EARLY).cast("timestamp"))
    return R.unverified(table(spark, d, "papers"), table(spark, d, "paper_repo_links"), snapshots, _canonical(F.col("repo_url")))


_FIELDS = ", ".join(f'"{f}"' for f in EXPORT_FIELDS)
_PAYLOAD = ", ".join(f"""array_to_string(export_payload.authors, '; ') AS authors""" if f == "authors" else f'export_payload."{f}" AS "{f}"' for f in EXPORT_FIELDS)


@query(f"""
WITH r AS (SELECT DISTINCT ON (id, validated_at) id, lower(paper_id) AS paper_id, validated_at, exported_at, {_PAYLOAD} FROM validated_records WHERE paper_id IS NOT NULL ORDER BY id),
new AS (SELECT DISTINCT ON (paper_id) paper_id, validated_at, NULL::TIMESTAMPTZ AS exported_at, {_FIELDS} FROM r WHERE validated_at >= TIMESTAMPTZ '{SPLIT}+00' ORDER BY paper_id, validated_at DESC, id DESC),
old AS (SELECT DISTINCT ON (paper_id) paper_id, validated_at, exported_at, {_FIELDS} FROM r WHERE validated_at < TIMESTAMPTZ '{SPLIT}+00' ORDER BY paper_id, validated_at DESC, id DESC)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE paper_id NOT IN (SELECT paper_id FROM new)""")
def upsert_validated(spark: SparkSession, d: str) -> DataFrame:
    """Records of before a moment, then those of after it in their place, not exported yet."""
    rows = table(spark, d, "validated_records").where(F.col("paper_id").isNotNull()).select("id", F.lower("paper_id").alias("paper_id"), "validated_at", "exported_at", "export_payload")
    late = F.col("validated_at") >= F.lit(SPLIT).cast("timestamp")
    old = R.latest_by(rows.where(~late), ["paper_id"], F.col("validated_at"), F.col("id"))
    new = rows.where(late).withColumn("exported_at", F.lit(None).cast("timestamp"))
    after = R.last_writer_wins(old, new, ["paper_id"], "validated_at").select("paper_id", "validated_at", "exported_at", "export_payload.*")
    return after.withColumn("authors", F.array_join("authors", "; "))


@query("SELECT DISTINCT id, validated_at FROM validated_records WHERE exported_at IS NULL ORDER BY validated_at, id LIMIT 100")
def first_unexported(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "validated_records").where(F.col("exported_at").isNull()).select("id", "validated_at").distinct()
    return rows.orderBy("validated_at", "id").limit(100)


@query(f"SELECT DISTINCT id, coalesce(exported_at, TIMESTAMPTZ '{RUN_AT}+00') AS exported_at FROM validated_records")
def mark_exported(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "validated_records").select("id", "exported_at").distinct()
    return R.set_for_ids(rows, rows.where(F.col("exported_at").isNull()), "id", exported_at=F.lit(RUN_AT).cast("timestamp"))


_SHEET = "SELECT DISTINCT id, validated_at, " + ", ".join(f"coalesce(array_to_string(export_payload.authors, '; '), '') AS authors" if f == "authors" else f"coalesce(export_payload.\"{f}\"::VARCHAR, '') AS \"{f}\"" for f in EXPORT_FIELDS) + " FROM validated_records"


@query(f"WITH s AS ({_SHEET}) SELECT * EXCLUDE validated_at, floor(row_number() OVER (ORDER BY validated_at, id) / 500)::INT AS chunk FROM s")
def export_rows(spark: SparkSession, d: str) -> DataFrame:
    """The sheet of all records and the request that carries each row."""
    rows = sheet_rows(_once(table(spark, d, "validated_records").select("id", "validated_at", "export_payload.*")))
    return chunked(rows, ["validated_at", "id"]).select("id", *EXPORT_FIELDS, "chunk")


def _iso(column: str) -> str:
    return f"replace(strftime({column} AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f+00:00'), '.000000+', '+')"


def _blank(column: str) -> str:
    return f"regexp_replace({column}, '{_SPACES}', '', 'g') = ''"


_GATED = f"""
l AS (SELECT DISTINCT ON (lower(paper_id)) lower(paper_id) AS p, repo_url, evidence_type, {_url("repo_url")} AS k FROM paper_repo_links WHERE is_selected ORDER BY lower(paper_id), id DESC),
s AS ({_LATEST})"""
_REASON = f"""CASE WHEN arxiv_id IS NULL OR {_blank("arxiv_id")} THEN 'missing arxiv_id' WHEN authors IS NULL OR len(authors) = 0 THEN 'no authors' WHEN title IS NULL OR {_blank("title")} THEN 'empty title' END"""


def _exports(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return build_exports(*(table(spark, d, t) for t in ("papers", "paper_repo_links", "github_repo_snapshots")), _canonical, RUN_AT)


@query(f"""
WITH {_GATED}
SELECT p.id AS paper_id, '1.0' AS "schemaVersion", 'RESEARCH_PAPER' AS "recordType", 'arxiv' AS source_name, canonical_url AS source_url, canonical_url AS paper_url, title, CASE WHEN ok THEN l.repo_url END AS github_url,
CASE WHEN ok THEN stargazers_count END AS github_stars, CASE WHEN ok THEN evidence_type END AS github_evidence_type, '2025-03-01T00:00:00+00:00' AS "collectedAt", array_to_string(authors, '; ') AS authors,
{_iso("published_date")} AS published_date, CASE WHEN ok THEN {_iso("stars_fetched_at")} END AS github_stars_fetched_at
FROM (SELECT *, {_REASON} AS reason FROM papers) p LEFT JOIN l ON lower(p.id) = l.p LEFT JOIN (SELECT *, exists_verified AND api_status = 'OK' AS ok FROM s) s ON l.k = s.k WHERE reason IS NULL""")
def validate_exports(spark: SparkSession, d: str) -> DataFrame:
    return _exports(spark, d)[0].withColumn("authors", F.array_join("authors", "; "))


@query(f"SELECT id AS paper_id, {_REASON} AS reason FROM papers WHERE ({_REASON}) IS NOT NULL")
def validate_rejects(spark: SparkSession, d: str) -> DataFrame:
    return _exports(spark, d)[1]


@query(f"SELECT id AS paper_id, CASE {_REASON} WHEN 'missing arxiv_id' THEN 'ParsedPaper validation failed: arxiv_id must not be empty' WHEN 'no authors' THEN 'ParsedPaper validation failed: authors must not be empty' ELSE 'empty title' END AS reason FROM papers WHERE ({_REASON}) IS NOT NULL")
def stage_failures(spark: SparkSession, d: str) -> DataFrame:
    """Papers that the validation stage fails, in its own words."""
    return table(spark, d, "papers").select(F.col("id").alias("paper_id"), reject_reason(stage=True).alias("reason")).where(F.col("reason").isNotNull())


def _unique(name: str, column: str, where: str = "true", rule: str = "") -> str:
    key = f"lower({column})" if column.endswith("id") else column
    return f"SELECT '{name}' AS table_name, 'unique ({column}){rule}' AS rule, count(*) AS n_keys FROM (SELECT {key} FROM (SELECT DISTINCT * FROM {name} WHERE {where}) WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _referring(name: str, column: str, target: str) -> str:
    return f"SELECT '{name}', '{column} in {target}', count(DISTINCT lower({column})) FROM {name} WHERE lower({column}) NOT IN (SELECT lower(id) FROM {target})"


_KEY_RULES = [_unique(t, "id") for t in ("papers", "fetch_observations", "paper_repo_links", "github_repo_snapshots", "validated_records")] + [
    _unique("papers", "arxiv_id"), _unique("validated_records", "paper_id"), _unique("paper_repo_links", "paper_id", "is_selected", " where is_selected"),
    "SELECT 'paper_fetch_observations', 'unique (paper_id, fetch_observation_id)', count(*) FROM (SELECT lower(paper_id), lower(fetch_observation_id) FROM (SELECT DISTINCT * FROM paper_fetch_observations) WHERE paper_id IS NOT NULL AND fetch_observation_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1)",
    *(_referring(t, "paper_id", "papers") for t in ("fetch_observations", "paper_repo_links", "validated_records", "paper_fetch_observations")), _referring("paper_fetch_observations", "fetch_observation_id", "fetch_observations"),
]


@query(" UNION ALL ".join(_KEY_RULES))
def key_checks(spark: SparkSession, d: str) -> DataFrame:
    """How many keys break each rule of uniqueness and reference."""
    return key_violations({t: table(spark, d, t) for t in ("papers", "fetch_observations", "paper_repo_links", "github_repo_snapshots", "validated_records", "paper_fetch_observations")})


@query("SELECT id, CASE WHEN title IS NULL THEN 'skipped' ELSE 'parsed' END AS status, json_object('status', status, 'failure_reason', failure_reason) AS detail FROM papers")
def log_events(spark: SparkSession, d: str) -> DataFrame:
    papers = table(spark, d, "papers").select("id", "title", F.col("status").alias("s"), "failure_reason").withColumnRenamed("s", "status")
    logged = events(papers, "parse", F.when(F.col("title").isNull(), "skipped").otherwise("parsed"), RUN_AT, ["status", "failure_reason"], record_id=F.col("id"))
    return logged.select(F.col("record_id").alias("id"), "status", "detail")


@query("""SELECT DISTINCT id, CASE WHEN id IS NULL THEN 'id: missing' WHEN repo_url IS NULL THEN 'repo_url: missing' WHEN exists_verified IS NULL THEN 'exists_verified: missing'
WHEN stars_fetched_at IS NULL THEN 'stars_fetched_at: missing' WHEN api_status IS NULL THEN 'api_status: missing' WHEN api_status NOT IN ('OK', 'NOT_FOUND', 'RATE_LIMITED', 'ERROR') THEN 'api_status: not in its domain'
WHEN stargazers_count < 0 THEN 'stargazers_count: negative' END AS violation FROM github_repo_snapshots""")
def row_checks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "github_repo_snapshots").select("id", violation("github_repo_snapshots").alias("violation")).distinct()


@query(f"""
WITH s AS (SELECT DISTINCT id, {_url("repo_url")} AS k FROM github_repo_snapshots)
SELECT id, k AS repo_url, registered_at FROM s LEFT JOIN repo_registry r ON s.k = r.repo_url""")
def snapshot_registration(spark: SparkSession, d: str) -> DataFrame:
    """Each snapshot with its repository's registration; hot repositories are spread over tasks if the registry is too large to share."""
    rows = table(spark, d, "github_repo_snapshots").select("id", F.explode(F.array(_canonical(F.col("repo_url")))).alias("repo_url")).distinct()
    return lookup(rows, table(spark, d, "repo_registry").select("repo_url", "registered_at"), "repo_url", "id").select("id", "repo_url", "registered_at")


# Extraction results


@query("""
SELECT DISTINCT result_id, CASE WHEN json_valid(result_json) THEN json_extract_string(result_json, '$.validation_status') END AS validation_status FROM llm_live_result""")
def result_status(spark: SparkSession, d: str) -> DataFrame:
    """A field out of each result's JSON; NULL where the text can't be read."""
    rows = table(spark, d, "llm_live_result").select("result_id", "result_json").distinct()
    readable = F.try_parse_json("result_json").isNotNull()
    return rows.select("result_id", F.when(readable, F.get_json_object("result_json", "$.validation_status")).alias("validation_status"))


@query("""
WITH r AS (SELECT DISTINCT result_id, result_json FROM llm_live_result WHERE json_valid(result_json)),
f AS (SELECT result_id, coalesce(json_extract_string(result_json, '$.gemini.success') = 'true', false) AS g, coalesce(json_extract_string(result_json, '$.cohere.success') = 'true', false) AS c,
      coalesce(json_extract_string(result_json, '$.groq.success') = 'true', false) AS q FROM r)
SELECT result_id, CASE WHEN NOT g AND NOT c THEN 'no_extraction' WHEN NOT g AND NOT q THEN 'fallback_adjudication_failed' WHEN NOT g THEN 'fallback' WHEN NOT c THEN 'review_failed' WHEN NOT q THEN 'adjudication_failed' ELSE 'complete' END AS "exit" FROM f""")
def result_route(spark: SparkSession, d: str) -> DataFrame:
    """How each readable result left the pipeline, from the success of its stages."""
    rows = table(spark, d, "llm_live_result").select("result_id", "result_json").distinct().where(F.try_parse_json("result_json").isNotNull())
    ok = lambda p: F.get_json_object("result_json", f"$.{p}.success") == "true"
    return rows.select("result_id", route(ok("gemini"), ok("cohere"), ok("cohere"), ok("groq")).alias("exit"))


@query()
def ground_results(spark: SparkSession, d: str) -> DataFrame:
    """Final extractions held against the first provider's quotes as evidence."""
    rows = table(spark, d, "llm_live_result").select("result_id", "result_json").distinct()
    first = decode(F.get_json_object("result_json", "$.gemini.result"), EXTRACTION)
    held = rows.select("result_id", F.coalesce(F.array_join(first["evidence_quotes"], " "), F.lit("")).alias("evidence"), decode(F.get_json_object("result_json", "$.final_extraction"), EXTRACTION).alias("x"))
    return ground(held, "evidence", "x").select("result_id", "validation_status", F.array_join("validation_errors", "\n").alias("errors"))


_CASES = """SELECT doc_id, text AS t, source, lang, substr(text, 1, 20) AS q1, upper(substr(text, 5, 15)) AS q2, substr(text, 3, 12) AS k1, CASE WHEN n_chars % 3 > 0 THEN lower(substr(text, 1, 10)) END AS k2,
coalesce(lang = 'en', false) AS s1, n_chars % 2 = 0 AS s2, CASE WHEN n_chars % 7 > 0 THEN n_chars % 5 = 0 END AS remote FROM documents"""


@query(f"""
WITH c AS ({_CASES}), l AS (SELECT doc_id, [
  CASE WHEN q1 IS NOT NULL AND NOT coalesce(contains(t, q1), false) THEN '{BAD_QUOTE}' || q1 END, CASE WHEN q2 IS NOT NULL AND NOT coalesce(contains(t, q2), false) THEN '{BAD_QUOTE}' || q2 END,
  CASE WHEN k1 IS NULL AND s1 THEN '{NO_QUOTE}company' END, CASE WHEN k1 IS NOT NULL AND NOT contains(t, k1) THEN '{BAD_CLAIM_QUOTE}company' END, CASE WHEN k1 IS NOT NULL AND s1 AND source IS NULL THEN '{NO_VALUE}company' END,
  CASE WHEN k2 IS NULL AND s2 THEN '{NO_QUOTE}is_remote' END, CASE WHEN k2 IS NOT NULL AND NOT contains(t, k2) THEN '{BAD_CLAIM_QUOTE}is_remote' END, CASE WHEN k2 IS NOT NULL AND s2 THEN '{NO_VALUE}is_remote' END,
  CASE WHEN source IS NOT NULL AND NOT s1 THEN '{NO_CLAIM}company' END, CASE WHEN lang IS NOT NULL THEN '{NO_CLAIM}role_family' END, CASE WHEN remote IS NOT NULL AND NOT s2 THEN '{NO_CLAIM}is_remote' END] AS all_ FROM c),
e AS (SELECT doc_id, list_filter(all_, lambda x: x IS NOT NULL) AS errors FROM l)
SELECT doc_id, CASE WHEN len(errors) = 0 THEN 'VALIDATED' ELSE 'QUARANTINE' END AS validation_status, array_to_string(errors, chr(10)) AS errors FROM e""")
def ground_documents(spark: SparkSession, d: str) -> DataFrame:
    """Extractions made of each document's source, language and length, with quotes of its text verbatim and altered, held against the text: every rule of grounding."""
    t, n = F.col("text"), F.col("n_chars")
    none = F.lit(None).cast("string")
    claim = lambda name, value, quote, ok: F.struct(F.lit(name).alias("field"), value.alias("value"), quote.alias("evidence_quote"), ok.alias("supported"))
    x = F.struct(
        F.col("source").alias("company"), F.col("lang").alias("role_family"), F.when(n % 7 > 0, n % 5 == 0).alias("is_remote"), none.alias("summary"), F.array(F.substring(t, 1, 20), F.upper(F.substring(t, 5, 15))).alias("evidence_quotes"),
        F.array(claim("company", F.col("source"), F.substring(t, 3, 12), F.col("lang") == "en"), claim("is_remote", none, F.when(n % 3 > 0, F.lower(F.substring(t, 1, 10))), n % 2 == 0)).alias("claims"),
    )
    held = ground(table(spark, d, "documents").select("doc_id", "text", x.alias("x")), "text", "x")
    return held.select("doc_id", "validation_status", F.array_join("validation_errors", "\n").alias("errors"))


@query("""
WITH r AS (SELECT DISTINCT result_id, result_json FROM llm_live_result WHERE json_valid(result_json)), x AS (SELECT result_id, json_extract(result_json, '$.final_extraction') AS x FROM r)
SELECT result_id, x ->> 'company' AS company, x ->> 'role_family' AS role_family FROM x WHERE json_type(x) = 'OBJECT' AND coalesce(json_type(x -> 'company'), 'NULL') IN ('VARCHAR', 'NULL') AND coalesce(json_type(x -> 'role_family'), 'NULL') IN ('VARCHAR', 'NULL')""")
def decoded_results(spark: SparkSession, d: str) -> DataFrame:
    """Final extractions that are objects, read by the decoder; whatever else is odd in them."""
    rows = table(spark, d, "llm_live_result").select("result_id", "result_json").distinct().where(F.try_parse_json("result_json").isNotNull())
    found = rows.withColumn("v", F.try_variant_get(F.try_parse_json("result_json"), "$.final_extraction", "variant"))
    text = lambda f: F.coalesce(F.schema_of_variant(F.try_variant_get("v", f"$.{f}", "variant")), F.lit("VOID")).isin("STRING", "VOID")
    kept = found.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")) & text("company") & text("role_family"))
    x = decode(F.get_json_object("result_json", "$.final_extraction"), EXTRACTION)
    return kept.select("result_id", x["company"].alias("company"), x["role_family"].alias("role_family"))


# Stores and sheets: what is written and read again


def _folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT DISTINCT paper_id, fetch_observation_id, linked_at FROM (SELECT DISTINCT ON (paper_id, fetch_observation_id) * FROM paper_fetch_observations WHERE paper_id IS NOT NULL AND fetch_observation_id IS NOT NULL ORDER BY paper_id, fetch_observation_id, linked_at)")
def stored_links(spark: SparkSession, d: str) -> DataFrame:
    """Links put into a migrated store twice, read from it."""
    store = SnapshotStore(spark, _folder(spark, "store"))
    store.migrate()
    store.migrate()
    links = table(spark, d, "paper_fetch_observations")
    for _ in range(2):
        store.put_if_absent("paper_fetch_observations", links, ["paper_id", "fetch_observation_id"])
    return store.read("paper_fetch_observations")


@query(f"WITH s AS ({_SHEET}) SELECT * EXCLUDE (id, validated_at) FROM s")
def written_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The sheet of all records, written, written again and read from where it was written."""
    rows = sheet_rows(_once(table(spark, d, "validated_records").select("id", "validated_at", "export_payload.*"))).orderBy("validated_at", "id").select(*EXPORT_FIELDS)
    place = _folder(spark, "sheets")
    for _ in range(2):
        write_sheet(rows, place, "sheet")
    return read_sheet(spark, place, "sheet")
