"""Schemas, value domains and row checks of the evidence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The domains of the enumerated columns.
FETCH_STATUS = ("OK", "ERROR", "TIMEOUT")
PAPER_STATUS = ("DISCOVERED", "FETCHED", "PARSED", "RESOLVING_REPO", "RESOLVED", "VALIDATED", "EXPORTED", "FAILED")
EVIDENCE_STRENGTH = {"authoritative_paper_page": 1, "trusted_metadata": 2, "pwc_verified": 3, "pwc_ai_agent_parsed": 4}
ASSOCIATION_METHODS = ("explicit_link_parsed", "metadata_field", "pwc_api_field")
API_STATUS = ("OK", "NOT_FOUND", "RATE_LIMITED", "ERROR")

EXPORT_FIELDS = ("schemaVersion", "recordType", "source_name", "source_url", "title", "authors", "paper_url", "github_url", "github_stars", "published_date", "collectedAt", "github_stars_fetched_at", "github_evidence_type")

TABLES = {
    "papers": "id string, arxiv_id string, canonical_url string, title string, authors array<string>, abstract string, published_date timestamp, status string, failure_reason string, first_seen_at timestamp, last_seen_at timestamp, updated_at timestamp",
    "fetch_observations": "id string, paper_id string, source_name string, source_url string, raw_payload struct<atom_xml: string, html: string>, content_hash string, fetched_at timestamp, http_status int, fetch_status string",
    "paper_fetch_observations": "paper_id string, fetch_observation_id string, linked_at timestamp",
    "paper_repo_links": "id string, paper_id string, repo_url string, evidence_type string, evidence_strength int, evidence_source_url string, evidence_locator string, evidence_text string, association_method string, observed_at timestamp, is_selected boolean",
    "github_repo_snapshots": "id string, repo_url string, exists_verified boolean, stargazers_count int, stars_fetched_at timestamp, api_status string",
    "validated_records": "id string, paper_id string, schema_version string, record_type string, export_payload struct<" + ", ".join(f"{f}: {'array<string>' if f == 'authors' else 'int' if f == 'github_stars' else 'string'}" for f in EXPORT_FIELDS) + ">, validated_at timestamp, exported_at timestamp",
    "pipeline_log": "id string, ts timestamp, stage string, source string, record_id string, status string, attempt int, latency_ms int, error_type string, provider string, detail string",
}

#: Tables that queries read besides these, and what the stored form of a table adds to it.
INPUTS = {
    **TABLES,
    "github_repo_snapshots": TABLES["github_repo_snapshots"] + ", loaded_at timestamp",
    "llm_live_result": "result_id bigint, received_at timestamp, result_json string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, paper_id string, repo_url string, created_at timestamp",
    "repo_registry": "repo_url string, registered_at timestamp, removed_at timestamp",
    "given_name_forms": "given_name string, short_form string",
    "mix_targets": "source string, target_share double, max_repeats int",
    "pack_capacity": "container string, capacity_tokens int",
    "reading_labels": "doc_id bigint, rater string, band string",
}

_DOMAINS = {
    "papers": {"status": PAPER_STATUS},
    "fetch_observations": {"fetch_status": FETCH_STATUS},
    "paper_repo_links": {"evidence_type": tuple(EVIDENCE_STRENGTH), "evidence_strength": (1, 2, 3, 4), "association_method": ASSOCIATION_METHODS},
    "github_repo_snapshots": {"api_status": API_STATUS},
}
_NEEDED = {
    "papers": ("id", "arxiv_id", "canonical_url", "status"),
    "fetch_observations": ("id", "source_name", "source_url", "content_hash", "fetched_at", "fetch_status"),
    "paper_fetch_observations": ("paper_id", "fetch_observation_id"),
    "paper_repo_links": ("id", "paper_id", "repo_url", "evidence_type", "evidence_strength", "evidence_source_url", "association_method"),
    "github_repo_snapshots": ("id", "repo_url", "exists_verified", "stars_fetched_at", "api_status"),
    "validated_records": ("paper_id", "export_payload"),
    "pipeline_log": ("stage", "status"),
}


#: Keys that may stand once: (columns, a condition or ""). Values of columns that end in id are UUID text, compared in lower case.
UNIQUE = {
    "papers": [(("id",), ""), (("arxiv_id",), "")],
    "fetch_observations": [(("id",), "")],
    "paper_repo_links": [(("id",), ""), (("paper_id",), "is_selected")],
    "github_repo_snapshots": [(("id",), "")],
    "validated_records": [(("id",), ""), (("paper_id",), "")],
    "paper_fetch_observations": [(("paper_id", "fetch_observation_id"), "")],
}
#: Columns that refer to the id of another table; NULL refers to nothing.
REFERENCES = {
    "fetch_observations": {"paper_id": "papers"},
    "paper_repo_links": {"paper_id": "papers"},
    "validated_records": {"paper_id": "papers"},
    "paper_fetch_observations": {"paper_id": "papers", "fetch_observation_id": "fetch_observations"},
}
#: What a row has where a writer says nothing; now: the time of the run.
DEFAULTS = {
    "papers": {"status": "DISCOVERED", "first_seen_at": "now", "last_seen_at": "now", "updated_at": "now"},
    "fetch_observations": {"fetched_at": "now"},
    "paper_fetch_observations": {"linked_at": "now"},
    "paper_repo_links": {"observed_at": "now", "is_selected": False},
    "github_repo_snapshots": {"stars_fetched_at": "now"},
    "validated_records": {"schema_version": "1.0", "record_type": "RESEARCH_PAPER", "validated_at": "now"},
    "pipeline_log": {"ts": "now"},
}


def with_defaults(df: DataFrame, table: str, run_at: str) -> DataFrame:
    """df in the table's columns: those it lacks, and NULLs where the table has a default, filled in."""
    out = {}
    for f in schema(table):
        value = DEFAULTS.get(table, {}).get(f.name)
        default = F.lit(run_at if value == "now" else value).cast(f.dataType)
        out[f.name] = F.coalesce(F.col(f.name), default) if f.name in df.columns else default
    return df.select(*(c.cast(schema(table)[n].dataType).alias(n) for n, c in out.items()))


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule, n_keys): how many keys break each rule that one row can't show: keys that stand twice, references without a target.

    Rows that are equal throughout count as one: an append that ran twice is no second key. All rules are reported, also those that nothing
    breaks; those whose tables aren't given are left out. NULL keys break nothing here (see violation). Counts are combined before they
    are shuffled; a target is met by its distinct keys.
    """
    key = lambda c: F.lower(c) if c.endswith("id") else F.col(c)
    out = None
    for name, df in tables.items():
        found = []
        for columns, condition in UNIQUE.get(name, []):
            rows = df.where(condition) if condition else df
            whole = F.xxhash64(*(F.col(c) if not t.startswith("struct") else F.to_json(c) for c, t in rows.dtypes))
            each = rows.dropna(subset=list(columns)).groupBy(*(key(c).alias(f"__{n}") for n, c in enumerate(columns))).agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
            found.append((f"unique ({', '.join(columns)})" + (f" where {condition}" if condition else ""), each.where("low <> high")))
        for column, target in REFERENCES.get(name, {}).items():
            if target in tables:
                keys = df.select(F.lower(column).alias("__k")).where(F.col("__k").isNotNull()).distinct()
                found.append((f"{column} in {target}", keys.join(tables[target].select(F.lower("id").alias("__k")).distinct(), "__k", "left_anti")))
        for rule, broken in found:
            one = broken.agg(F.count(F.lit(1)).alias("n_keys")).select(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "n_keys")
            out = one if out is None else out.unionByName(one)
    return out


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def violation(table: str) -> Column:
    """The first rule a row of this table breaks, as text; NULL for a good row. Enumerations, needed columns, counts below zero."""
    found = F.lit(None).cast("string")
    if table == "github_repo_snapshots":
        found = F.when(F.col("stargazers_count") < 0, "stargazers_count: negative")
    if table == "paper_repo_links":  # the strength is the evidence type's
        found = F.when(F.col("evidence_strength") != evidence_strength(F.col("evidence_type")), "evidence_strength: not that of its type")
    for name, domain in reversed(_DOMAINS.get(table, {}).items()):
        found = F.when(F.col(name).isNotNull() & ~F.col(name).isin(*domain), f"{name}: not in its domain").otherwise(found)
    for name in reversed(_NEEDED[table]):
        found = F.when(F.col(name).isNull(), f"{name}: missing").otherwise(found)
    return found


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the column violation), in one reading of df each; nothing is dropped."""
    judged = df.withColumn("violation", violation(table))
    return judged.where(F.col("violation").isNull()).drop("violation"), judged.where(F.col("violation").isNotNull())


def evidence_strength(kind: Column) -> Column:
    """1 (strongest) to 4 of an evidence type; NULL for others."""
    out = F.lit(None).cast("int")
    for name, strength in EVIDENCE_STRENGTH.items():
        out = F.when(kind == name, strength).otherwise(out)
    return out
