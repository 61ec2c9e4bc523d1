"""Queries of the text problems, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.boilerplate import main_content, page_blocks
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.names import FILLERS, link_names, name_pairs
from ledgerline.llm.packing import LOSS_SHARE, TOKENS_A_SEGMENT, pack_documents, packing_report
from ledgerline.llm.reading import reading_bands
from ledgerline.llm.tokens import canonical_source, token_counts
from ledgerline.session import cut, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return main_content(table(spark, d, "fetch_observations"), "id", "source_url", "raw_payload.html")


def p2_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of each page, the article's or not: what block_no counts."""
    return page_blocks(table(spark, d, "fetch_observations"), "id", "raw_payload.html")


def p2_kept(spark: SparkSession, d: str) -> DataFrame:
    """Pages of which a block came out that the page doesn't have, or one twice: none."""
    found = p2_found(spark, d).groupBy("id").agg(F.max("block_no").alias("last"), F.count(F.lit(1)).alias("n"), F.count_distinct("block_no").alias("kinds"))
    return p2_blocks(spark, d).join(found, "id", "left").select("id", F.coalesce((F.col("last") <= F.col("blocks")) & (F.col("n") == F.col("kinds")), F.lit(True)).alias("inside"))


def p5_entities(spark: SparkSession, d: str) -> DataFrame:
    return link_names(table(spark, d, "papers"), "authors", table(spark, d, "given_name_forms"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return name_pairs(p5_entities(spark, d))


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(token_counts(table(spark, d, "documents"), "doc_id", "text"))
    return pack_documents(sizes, table(spark, d, "pack_capacity"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(p6_pack(spark, d), table(spark, d, "pack_capacity"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = cut(token_counts(table(spark, d, "documents"), "doc_id", "text", "source"))
    return mix_sources(sizes, table(spark, d, "mix_targets"))


def p7_draws(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def _banded(spark: SparkSession, d: str) -> DataFrame:
    return reading_bands(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _banded(spark, d).select("doc_id", "band")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and mean score by source, language and band."""
    documents = table(spark, d, "documents").select("doc_id", canonical_source(F.col("source")).alias("source"), F.substring(F.lower(F.trim("lang")), 1, 2).alias("lang"))
    return _banded(spark, d).join(documents, "doc_id").groupBy("source", "lang", "band").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("score").alias("mean_score"))


def p6_placed(spark: SparkSession, d: str) -> DataFrame:
    """Each document in each container: whether it was placed, whether its pieces go on from each other without gaps, and whether only what exceeds the capacity was split."""
    documents = table(spark, d, "documents")
    sizes = cut(token_counts(documents, "doc_id", "text"))
    capacities = table(spark, d, "pack_capacity")
    pieces = pack_documents(sizes, capacities).groupBy("container", "doc_id").agg(
        (F.count("bin") > 0).alias("placed"), F.sum("tokens").alias("tokens"), F.max(F.col("first_token") + F.col("tokens")).alias("end"), F.count(F.lit(1)).alias("n")
    )
    judged = pieces.join(sizes.select("doc_id", F.col("tokens").alias("size")), "doc_id").join(F.broadcast(capacities), "container")
    whole = (F.col("tokens") == F.col("size")) & (F.col("end") == F.col("size")) & (F.col("n") == F.greatest(F.ceil(F.col("size") / F.col("capacity_tokens")), F.lit(1)))
    return judged.select("container", "doc_id", "placed", whole.alias("whole"))


def p6_limits(spark: SparkSession, d: str) -> DataFrame:
    """Containers that break a limit, for each kind and limit."""
    capacities = table(spark, d, "pack_capacity")
    bins = p6_pack(spark, d).where(F.col("bin").isNotNull()).groupBy("container", "bin").agg(F.sum("tokens").alias("tokens"), F.sum("loss_tokens").alias("loss"), F.count(F.lit(1)).alias("segments"))
    met = bins.join(F.broadcast(capacities), "container")
    c = F.col("capacity_tokens")
    broken = {"over_tokens": F.col("tokens") > c, "over_loss": F.col("loss") > F.floor(c * LOSS_SHARE), "over_segments": F.col("segments") > F.floor(c / TOKENS_A_SEGMENT)}
    return met.groupBy("container").agg(*(F.count_if(b).alias(n) for n, b in broken.items()))


def p7_sources(spark: SparkSession, d: str) -> DataFrame:
    """Each target with what it is drawn from, and whether the draws meet it but for a hundredth of all tokens or one document, or take all they may."""
    sizes = cut(token_counts(table(spark, d, "documents"), "doc_id", "text", "source"))
    largest = sizes.groupBy(canonical_source(F.col("source")).alias("source")).agg(F.max("tokens").alias("largest"))
    shares = mix_sources(sizes, table(spark, d, "mix_targets"))[1].join(largest.where(F.col("source").isNotNull()), "source", "left")
    off = F.abs(F.col("reached_share") - F.col("target_share"))
    met = (off < 0.01) | (off * F.col("total_tokens") <= F.col("largest")) | (F.col("draws") == F.col("documents") * F.col("max_repeats"))
    return shares.select("source", "target_share", "max_repeats", "documents", met.alias("met"))


def p7_copies(spark: SparkSession, d: str) -> DataFrame:
    """Documents drawn more often than their source allows, twice under one copy number, or of no target: none, by source."""
    draws, _ = _mixed(spark, d)
    targets = table(spark, d, "mix_targets")
    each = draws.groupBy("source", "doc_id").agg(F.max("copy_no").alias("last"), F.count(F.lit(1)).alias("n"))
    met = each.join(F.broadcast(targets), "source", "full")
    return met.groupBy("source").agg(F.count_if((F.col("n") > F.col("max_repeats")) | (F.col("n") != F.col("last")) | F.col("max_repeats").isNull()).alias("wrong"))


def p8_rated(spark: SparkSession, d: str) -> DataFrame:
    """Documents that have a band, and whether it is the most likely one's side of the scale."""
    return _banded(spark, d).select("doc_id", F.col("band").isin("plain", "student", "expert").alias("known"), (F.abs(F.col("p_plain") + F.col("p_student") + F.col("p_expert") - 1) < 1e-6).alias("sums"))


def p5_spellings(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with letters that isn't a filler, once, whoever it belongs to."""
    return p5_entities(spark, d).select("name")


QUERIES = {f.__name__: f for f in (p2_found, p2_blocks, p2_kept, p5_found, p5_entities, p5_spellings, p6_pack, p6_fill, p6_placed, p6_limits, p7_draws, p7_shares, p7_sources, p7_copies, p8_found, p8_profile, p8_rated)}
_SOURCE = r"nullif(regexp_replace(regexp_replace(lower({0}), '^[\s_-]+|[\s_-]+$', '', 'g'), '[\s_-]+', '_', 'g'), '')"
_FILLERS = ", ".join(f"'{x}'" for x in sorted(FILLERS))
#: What SQL can say of these problems: what is taken in and what must hold of the result, not the choice itself.
SQL: dict[str, str] = {
    "p2_blocks": r"""SELECT DISTINCT id, len(regexp_extract_all(regexp_replace(raw_payload.html, '(?is)<script.*?(</script>|\z)|<style.*?(</style>|\z)|<!--.*?(-->|\z)|="[^"]*"|=\x27[^\x27]*\x27', '', 'g'),
'(?i)<(h[1-6]|p|li|dt|dd|td|pre|blockquote|figcaption)(\s[^>]*)?/?>')) AS blocks FROM fetch_observations WHERE raw_payload.html IS NOT NULL""",
    "p2_kept": "SELECT DISTINCT id, true AS inside FROM fetch_observations WHERE raw_payload.html IS NOT NULL",
    "p5_spellings": rf"""SELECT name FROM (SELECT DISTINCT unnest(authors) AS name FROM papers)
WHERE regexp_matches(name, '\p{{L}}') AND trim(regexp_replace(lower(regexp_replace(name, '\([^)]*\)', ' ', 'g')), '[^\p{{L}}-]+', ' ', 'g')) NOT IN ({_FILLERS})""",
    "p6_placed": "SELECT container, doc_id, text IS NOT NULL AND text <> '' AS placed, true AS whole FROM documents, pack_capacity",
    "p6_limits": "SELECT container, 0 AS over_tokens, 0 AS over_loss, 0 AS over_segments FROM pack_capacity",
    "p7_sources": f"""SELECT {_SOURCE.format("t.source")} AS source, sum(DISTINCT target_share) AS target_share, max(max_repeats) AS max_repeats, count(d.doc_id) AS documents, true AS met
FROM mix_targets t LEFT JOIN documents d ON {_SOURCE.format("d.source")} = {_SOURCE.format("t.source")} AND d.text <> '' GROUP BY 1""",
    "p7_copies": "SELECT source, 0 AS wrong FROM mix_targets",
    "p8_rated": r"SELECT doc_id, true AS known, true AS sums FROM documents WHERE len(list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> '')) >= 40",
}
