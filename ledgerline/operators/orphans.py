"""References to records that do not exist: a Bloom filter of the parents' keys proves most orphans, an exact join judges the rest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import uuid_key
from ledgerline.functions.urls import repo_url
from ledgerline.operators.skew import MOST_SHARED, salted_lookup
from ledgerline.session import cut

#: A filter is kept in parts of at most 2**26 bits (8 MB), of which there are at most MAX_PARTS (128 MB, some 90 million keys at 12 bits each); with
#: more keys fewer bits are left for each, and more references are checked by the join.
MAX_BITS, MAX_PARTS = 1 << 26, 16
_HASHES = 4


def _positions(key: Column, bits: int) -> list[Column]:
    """_HASHES bit positions of a key by double hashing; bits is a power of two, so masks keep sums from overflowing."""
    a, b = (F.xxhash64(F.lit(seed), key).bitwiseAND(bits - 1) for seed in "ab")
    return [(a + F.lit(k) * b.bitwiseOR(1)).bitwiseAND(bits - 1) for k in range(_HASHES)]


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)).cast("int")


def bloom_words(keys: DataFrame, key: str, n_keys: int, bits_per_key: int = 12, max_bits: int = MAX_BITS, max_parts: int = MAX_PARTS) -> tuple[DataFrame, int, int]:
    """The filter as rows (part, words: array of 64-bit words), the bits of a part (at most max_bits, a power of two) and the number of parts.

    Keys are spread over the parts by a hash. Bits are combined in each task before the shuffle (a task sends at most bits/64 words a part);
    NULL keys set none; a part without keys has no row.
    """
    parts = min(max_parts, max(1, -(-n_keys * bits_per_key // max_bits)))
    wanted, bits = max(64, n_keys * bits_per_key / parts), 64
    while bits < min(wanted, max_bits):
        bits *= 2
    position = F.explode(F.array(*_positions(F.col(key), bits)))
    words = (
        keys.where(F.col(key).isNotNull())
        .select(_part(F.col(key), parts).alias("part"), position.alias("p"))
        .groupBy("part", F.shiftright("p", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("mask"))
    )

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for part, at, masks in zip(pdf["part"], pdf["at"], pdf["masks"]):
                row = np.zeros(bits // 64, np.int64)
                row[at] = masks
                rows.append((part, row))
            yield pd.DataFrame(rows, columns=["part", "words"])

    pairs = words.groupBy("part").agg(F.collect_list(F.struct("word", "mask")).alias("w"))
    return pairs.select("part", F.col("w.word").alias("at"), F.col("w.mask").alias("masks")).mapInPandas(dense, "part int, words array<bigint>"), bits, parts


def might_contain(rows: DataFrame, key: str, filter_: tuple[DataFrame, int, int], name: str = "__possible") -> DataFrame:
    """rows with a column that is false only where key is certainly not in the filter; NULL for a NULL key. The filter goes to all tasks; hand it over stored."""
    words, bits, parts = filter_
    met = rows.join(F.broadcast(words.select(F.col("part").alias("__part"), F.col("words").alias("__words"))), _part(F.col(key), parts) == F.col("__part"), "left")
    hits = [F.call_function("shiftright", F.get("__words", F.shiftright(p, 6).cast("int")), (p % 64).cast("int")).bitwiseAND(1) == 1 for p in _positions(F.col(key), bits)]
    found = hits[0]
    for h in hits[1:]:
        found = found & h
    return met.withColumn(name, F.when(F.col(key).isNotNull(), F.coalesce(found, F.lit(False)))).drop("__part", "__words")


@dataclass(frozen=True)
class Reference:
    """A referring table and its columns: the row's id, the (already canonical) key and the time of the reference."""

    name: str
    rows: DataFrame
    row_id: Column
    key: Column
    time: Column


def find_orphans(references: list[Reference], parents: DataFrame, key: str, since: str, until: str | None = None, max_bits: int = MAX_BITS, most_shared: int = MOST_SHARED) -> DataFrame:
    """(ref_table, row_id, ref_month, kind): one row for each referring row whose target fails.

    kind is `missing` (no parent has the key), `late` (the reference is before the parent's `since`) or `removed` (at or after its
    `until`). References that the Bloom filter of the parents' keys rejects are certain to be missing; only the
    others are verified against the parents: where they are while there are at most most_shared parents, else by a join with hot keys spread
    over tasks. The parents, one row a key, and their filter are stored in the shared folder; references are read once (once more to find hot keys if there
    are many parents). NULL keys are no references; a row without a time is `missing` or nothing, its month NULL. Rows with the same id count
    once (equal rows without id too). Parents named twice have the earliest `since`, and an `until` only if each row has one. Empty
    tables give no rows, but empty parents make every reference missing. Only the columns named are read, so other columns can't clash.
    """
    known = cut(parents.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__parent")).agg(
        F.min(since).alias("__since"), (F.when(F.count(until) == F.count(F.lit(1)), F.max(until)) if until else F.lit(None).cast("timestamp")).alias("__until"), F.lit(True).alias("__known")
    ))
    n_keys = known.count()
    words, bits, parts = bloom_words(known, "__parent", n_keys, max_bits=max_bits)
    rows = None
    for r in references:
        one = r.rows.select(F.lit(r.name).alias("ref_table"), r.row_id.alias("row_id"), F.explode(F.array(r.key)).alias("__key"), r.time.cast("timestamp").alias("__time"))
        rows = one if rows is None else rows.unionByName(one)
    judged = might_contain(rows.where(F.col("__key").isNotNull()), "__key", (cut(words), bits, parts))
    # What the filter rejects meets no parent.
    asked = judged.select("ref_table", "row_id", "__time", F.when(F.col("__possible"), F.col("__key")).alias("__parent"))
    checked = asked.join(F.broadcast(known), "__parent", "left") if n_keys <= most_shared else salted_lookup(asked, known, "__parent", "row_id")
    kind = (
        F.when(F.col("__known").isNull(), "missing")
        .when(F.col("__time") < F.col("__since"), "late")
        .when(F.col("__time") >= F.col("__until"), "removed")
    )
    return checked.select("ref_table", "row_id", F.date_format("__time", "yyyy-MM").alias("ref_month"), kind.alias("kind")).where(F.col("kind").isNotNull()).distinct()


def evidence_orphans(links: DataFrame, snapshots: DataFrame, validated: DataFrame, registry: DataFrame, papers: DataFrame, host: str = "codeforge.example") -> DataFrame:
    """All references of the evidence tables whose target fails: repositories in the registry, papers in papers.

    A repository URL that names no repository under the URL rule can match nothing and is `missing`, compared as it stands.
    """
    url = lambda: F.coalesce(repo_url(F.col("repo_url"), host, reserved=()), F.col("repo_url"))
    repositories = find_orphans(
        [
            Reference("paper_repo_links", links, F.col("id"), url(), F.col("observed_at")),
            Reference("github_repo_snapshots", snapshots, F.col("id"), url(), F.col("stars_fetched_at")),
        ],
        registry.select(F.explode(F.array(url())).alias("k"), "registered_at", "removed_at"), "k", "registered_at", "removed_at",
    )
    named = find_orphans(
        [Reference("validated_records", validated, F.col("id"), uuid_key(F.col("paper_id")), F.col("validated_at"))], papers.select(uuid_key(F.col("id")).alias("k"), "first_seen_at"), "k", "first_seen_at"
    )
    return repositories.unionByName(named)


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphan references counted by table, month and kind."""
    return orphans.groupBy("ref_table", "ref_month", "kind").agg(F.count(F.lit(1)).alias("n_rows"))
