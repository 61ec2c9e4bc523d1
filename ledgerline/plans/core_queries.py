"""Queries of the core's training-data problems (p1, p3, p4), each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.history import repository_history
from ledgerline.operators.nested import flatten_feeds, flatten_results
from ledgerline.operators.orphans import evidence_orphans, orphan_report
from ledgerline.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    feeds = flatten_feeds(table(spark, d, "fetch_observations"), "id", "raw_payload.atom_xml", keys_only=True)
    return feeds.unionByName(flatten_results(table(spark, d, "llm_live_result"), "result_id", "result_json", keys_only=True))


def _flat(spark: SparkSession, d: str, node: str) -> DataFrame:
    return flatten_feeds(table(spark, d, "fetch_observations"), "id", "raw_payload.atom_xml").where(F.col("node") == node)


def p1_entries(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "entry").select("record_id", F.col("child_no").alias("entry_no"), F.col("name").alias("entry_id"), "title", "published", "updated", F.col("body").alias("summary"))


def p1_authors(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "author").select("record_id", F.col("parent_no").alias("entry_no"), F.col("child_no").alias("author_no"), "name")


def p1_claims(spark: SparkSession, d: str) -> DataFrame:
    flat = flatten_results(table(spark, d, "llm_live_result"), "result_id", "result_json")
    return flat.select("record_id", "node", F.col("child_no").alias("claim_no"), "claim_field", F.col("name").alias("value"), F.col("body").alias("evidence_quote"), "supported")


def _history(spark: SparkSession, d: str) -> DataFrame:
    return repository_history(table(spark, d, "github_repo_snapshots"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).select("repo_url", F.unix_micros("valid_from").alias("valid_from_us"))


def p3_versions(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).select("repo_url", "version", "gone", "stargazers_count", F.unix_micros("valid_from").alias("valid_from_us"), F.unix_micros("valid_to").alias("valid_to_us"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return evidence_orphans(*(table(spark, d, t) for t in ("paper_repo_links", "github_repo_snapshots", "validated_records", "repo_registry", "papers")))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p4_found(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_entries, p1_authors, p1_claims, p3_found, p3_versions, p4_found, p4_report)}

# The URL rule for what the tables hold, in DuckDB's dialect.
_SLUG = r"""regexp_extract(regexp_replace({0}, '[\t\r\n]', '', 'g'), '(?i)^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:www\.)?codeforge\.example/+([^/?#]+)/+', 1)"""
_NAME = r"""regexp_replace(regexp_extract(regexp_replace({0}, '[\t\r\n]', '', 'g'), '(?i)^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:www\.)?codeforge\.example/+[^/?#]+/+([^/?#]+)', 1), '(\.git)?\s*$', '')"""


def _url(column: str) -> str:
    owner, name = _SLUG.format(column), _NAME.format(column)
    return f"CASE WHEN {owner} <> '' AND {name} <> '' THEN 'https://codeforge.example/' || {owner} || '/' || {name} END"


# Feeds as text, for what the tables hold: comments and prefixes away, whole feeds only; entries and authors by their tags; CDATA and entities decoded.
_ENTITIES = "&amp;|&lt;|&gt;|&quot;|&apos;|&#[0-9]+;|&#x[0-9a-fA-F]+;"
_OUTSIDE = r"""regexp_replace(t, '(?s)<!\[CDATA\[.*?\]\]>', '', 'g')"""
_STARTS, _ENDS = (rf"""len(regexp_extract_all({_OUTSIDE}, '<{slash}({tag})[ >]'))""" for slash, tag in (("", "feed|entry|author|name|title|summary|id|published|updated|affiliation"), ("/", "feed|entry|author|name|title|summary|id|published|updated|affiliation")))
FEEDS_SQL = rf"""
x AS (SELECT DISTINCT id, regexp_replace(regexp_replace(raw_payload.atom_xml, '(?s)<!--.*?-->', '', 'g'), '<(/?)[a-z]+:', '<\1', 'g') AS t FROM fetch_observations WHERE raw_payload.atom_xml IS NOT NULL),
good AS (SELECT * FROM x WHERE regexp_matches(t, '</feed>\s*$') AND {_STARTS} = {_ENDS} AND len(regexp_extract_all({_OUTSIDE}, '&')) = len(regexp_extract_all({_OUTSIDE}, '{_ENTITIES}'))),
listed AS (SELECT id, regexp_extract_all(t, '(?s)<entry(?: [^>]*)?>(.*?)</entry>', 1) AS all_ FROM good),
entries AS (SELECT id AS record_id, unnest(range(1, len(all_) + 1)) AS entry_no, unnest(all_) AS e FROM listed),
people AS (SELECT record_id, entry_no, regexp_extract_all(e, '(?s)<author>(.*?)</author>', 1) AS all_ FROM entries),
named AS (SELECT record_id, entry_no, unnest(range(1, len(all_) + 1)) AS k, unnest(all_) AS a FROM people)"""


def xml_text(c: str, tag: str) -> str:
    """The text of an element, decoded; NULL without the element."""
    inner = rf"""regexp_replace(regexp_extract({c}, '(?s)<{tag}>(.*?)</{tag}>', 1), '(?s)<!\[CDATA\[(.*?)\]\]>', '\1', 'g')"""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        inner = f"replace({inner}, '{entity}', '{char}')"
    return f"CASE WHEN contains({c}, '<{tag}>') THEN {inner} END"


_STRIP = r"regexp_replace({0}, '^[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]+|[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}]+$', '', 'g')"
AUTHORS_SQL = f"authors AS (SELECT record_id, entry_no, row_number() OVER (PARTITION BY record_id, entry_no ORDER BY k) AS author_no, name FROM (SELECT *, {_STRIP.format(xml_text('a', 'name'))} AS name FROM named) WHERE name <> '')"
def _opened(j: str, layers: int = 3) -> str:
    """JSON with texts that hold JSON unwrapped."""
    for _ in range(layers):
        j = f"(SELECT CASE WHEN json_type(q.j) = 'VARCHAR' AND json_valid(q.j ->> '$') THEN json(q.j ->> '$') ELSE q.j END FROM (SELECT {j} AS j) q)"
    return j


_PATHS = {"final_extraction": ["final_extraction"], "gemini": ["gemini", "result"], "cohere": ["cohere", "result", "corrected_extraction"], "groq": ["groq", "result"]}


def _member(path: list[str]) -> str:
    j = "root.j"
    for key in path:
        j = _opened(f"({j} -> '{key}')")
    return j


# Claims by recursion: a list's elements and a wrapper's values in order, until an object is a claim.
_IS_CLAIM = "(json_type(v) = 'OBJECT' AND (list_has_any(json_keys(v), ['field', 'value', 'evidence_quote', 'supported']) OR len(list_filter(json_extract(v, '$.*'), lambda c: json_type(c) IN ('OBJECT', 'ARRAY'))) = 0))"
CLAIMS_SQL = f"""
results AS (SELECT DISTINCT result_id::VARCHAR AS id, result_json FROM llm_live_result WHERE json_valid(result_json)),
root AS (SELECT id, {_opened("result_json::JSON")} AS j FROM results),
nodes AS ({" UNION ALL ".join(f"SELECT id, '{node}' AS node, {_member(path)} AS x FROM root" for node, path in _PATHS.items())}),
walk AS (
  SELECT id, node, []::BIGINT[] AS path, {_opened("(x -> 'claims')")} AS v FROM nodes WHERE json_type(x) = 'OBJECT'
  UNION ALL
  SELECT id, node, list_append(path, k), {_opened("c")} FROM (
    SELECT id, node, path, unnest(all_) AS c, unnest(range(1, len(all_) + 1)) AS k
    FROM (SELECT *, CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]') ELSE json_extract(v, '$.*') END AS all_ FROM walk WHERE json_type(v) IN ('ARRAY', 'OBJECT') AND NOT {_IS_CLAIM}) q) q),
claims AS (SELECT id AS record_id, node, row_number() OVER (PARTITION BY id, node ORDER BY path) AS claim_no, v FROM walk WHERE {_IS_CLAIM})"""
_FIELD = "coalesce(v ->> 'field', '')"
_READINGS = f"""
WITH told AS (
  SELECT DISTINCT {_url("repo_url")} AS repo_url, stars_fetched_at AS t, api_status = 'NOT_FOUND' AS gone,
         CASE WHEN api_status = 'OK' THEN stargazers_count END AS stargazers_count
  FROM github_repo_snapshots
  WHERE (api_status = 'OK' AND stargazers_count IS NOT NULL) OR api_status = 'NOT_FOUND'),
marked AS (
  SELECT *, lag(coalesce(stargazers_count, -1)) OVER (PARTITION BY repo_url ORDER BY t) AS before FROM told WHERE repo_url IS NOT NULL AND t IS NOT NULL),
starts AS (SELECT * FROM marked WHERE before IS DISTINCT FROM coalesce(stargazers_count, -1))
"""
_ORPHANS = f"""
WITH refs AS (
  SELECT 'paper_repo_links' AS ref_table, id, coalesce({_url("repo_url")}, repo_url) AS k, observed_at AS t FROM paper_repo_links
  UNION SELECT 'github_repo_snapshots', id, coalesce({_url("repo_url")}, repo_url), stars_fetched_at FROM github_repo_snapshots),
named AS (SELECT DISTINCT 'validated_records' AS ref_table, id, lower(paper_id) AS k, validated_at AS t FROM validated_records),
judged AS (
  SELECT ref_table, r.id, t, CASE WHEN g.repo_url IS NULL THEN 'missing' WHEN t < registered_at THEN 'late' WHEN t >= removed_at THEN 'removed' END AS kind
  FROM refs r LEFT JOIN repo_registry g ON r.k = g.repo_url WHERE r.k IS NOT NULL
  UNION ALL
  SELECT ref_table, r.id, t, CASE WHEN p.id IS NULL THEN 'missing' WHEN t < first_seen_at THEN 'late' END
  FROM named r LEFT JOIN papers p ON r.k = lower(p.id) WHERE r.k IS NOT NULL),
found AS (SELECT ref_table, id AS row_id, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS ref_month, kind FROM judged WHERE kind IS NOT NULL)
"""
SQL = {
    "p1_found": f"""WITH RECURSIVE {FEEDS_SQL}, {AUTHORS_SQL}, {CLAIMS_SQL}
SELECT record_id, 'entry' AS node, 0 AS parent_no, entry_no AS child_no, '' AS claim_field FROM entries UNION ALL SELECT record_id, 'author', entry_no, author_no, '' FROM authors
UNION ALL SELECT record_id, node, 0, claim_no, {_FIELD} FROM claims""",
    "p1_claims": f"WITH RECURSIVE {CLAIMS_SQL} SELECT record_id, node, claim_no, {_FIELD} AS claim_field, v ->> 'value' AS value, v ->> 'evidence_quote' AS evidence_quote, CASE WHEN json_type(v -> 'supported') = 'BOOLEAN' THEN (v ->> 'supported')::BOOLEAN END AS supported FROM claims",
    "p1_entries": f"WITH {FEEDS_SQL} SELECT record_id, entry_no, {xml_text('e', 'id')} AS entry_id, {xml_text('e', 'title')} AS title, {xml_text('e', 'published')} AS published, {xml_text('e', 'updated')} AS updated, {xml_text('e', 'summary')} AS summary FROM entries",
    "p1_authors": f"WITH {FEEDS_SQL}, {AUTHORS_SQL} SELECT record_id, entry_no, author_no, name FROM authors",
    "p3_found": _READINGS + "SELECT repo_url, epoch_us(t) AS valid_from_us FROM starts",
    "p3_versions": _READINGS
    + """SELECT repo_url, row_number() OVER w AS version, gone, stargazers_count, epoch_us(t) AS valid_from_us, epoch_us(lead(t) OVER w) AS valid_to_us
FROM starts WINDOW w AS (PARTITION BY repo_url ORDER BY t)""",
    "p4_found": _ORPHANS + "SELECT * FROM found",
    "p4_report": _ORPHANS + "SELECT ref_table, ref_month, kind, count(*) AS n_rows FROM found GROUP BY ALL",
}
