"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tokens import canonical_source

#: Documents' hash seeds take this many values; the table of sizes by source and seed, which the rates are set by, has no more rows a source.
SEEDS = 4096
ROTATIONS = 16


def poisson_steps(rate: float, most: int) -> list[float]:
    """F(0) .. F(most - 1) of the Poisson distribution: a document with seed u is drawn as often as steps lie below u."""
    if math.isinf(rate):
        return [0.0] * most
    if rate <= 0:
        return [1.0] * most
    total, steps = 0.0, []
    for k in range(most):  # by logarithms, as the first terms of a high rate are too small for a number
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        steps.append(min(total, 1.0))
    return steps


def fit_rate(mass: np.ndarray, target: float, most: int) -> float:
    """The rate at which the documents' own draws, capped at `most`, come closest to `target`; mass[k] is the size of all documents with seed k."""
    return _fit(mass, target, most)[0]


def _fit(mass: np.ndarray, target: float, most: int) -> tuple[float, float]:
    """fit_rate, and how far from the target it stays."""
    seeds = (np.arange(len(mass)) + 0.5) / len(mass)

    def drawn(rate: float) -> float:
        return float(mass @ (seeds[:, None] > np.array(poisson_steps(rate, most))[None, :]).sum(1)) if most else 0.0

    if most <= 0 or mass.sum() <= 0 or target <= 0:
        return 0.0, 0.0
    if target >= mass.sum() * most:
        return math.inf, 0.0
    low, high = 0.0, 1.0
    while drawn(high) < target:
        low, high = high, high * 2
        if high > 1e9:  # all copies of all documents but for rounding
            return math.inf, abs(float(mass.sum()) * most - target)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if drawn(middle) < target else (low, middle)
    return min(((low, target - drawn(low)), (high, drawn(high) - target)), key=lambda r: r[1])


def fit_rotation(mass: np.ndarray, target: float, most: int, near: float = 1e-3) -> tuple[int, float]:
    """(rotation, rate): seeds are turned by the first of ROTATIONS even steps that brings the draws within `near` of the target, else by the best.

    One long document can be a percent of a source, and whether it is drawn hangs on its seed; turning all of a source's seeds leaves
    them as even as they were and gives another draw.
    """
    best = None
    for k in range(ROTATIONS):
        turn = k * len(mass) // ROTATIONS
        rate, off = _fit(np.roll(mass, turn), target, most)
        if best is None or off < best[0]:
            best = off, turn, rate
        if off <= near * target:
            break
    return best[1], best[2]


def mix_sources(sizes: DataFrame, targets: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(draws, shares) of sizes (doc_id, source, tokens) drawn to targets (source, target_share, max_repeats), for a total of all sizes.

    draws: source, doc_id, copy_no, tokens, shuffle_key - one row a draw, in a global random order by shuffle_key. Each document has a hash
    seed; it is drawn as often as the inverse Poisson distribution of its source's rate says, at most max_repeats times. The rate is the mean
    repetition that gives the source's target; it is set over the actual seeds of all documents, so that the target is met to about one
    seed's size, not only on average. A source too small for its target is drawn max_repeats times throughout.
    shares: for each target its documents, draws, sizes, target and reached share of the total, and share of all that was drawn.

    Sources are compared in canonical form; documents of NULL or other sources count in the total only, as do those without tokens (NULL or 0),
    which are never drawn. targets is a table of settings (at most 1000 rows; repeated sources add up, with the largest max_repeats).
    The same input gives the same draws. sizes is read several times: hand it over stored. Empty tables give no draws.
    """
    spark = sizes.sparkSession
    wanted = targets.select(canonical_source(F.col("source")).alias("source"), "target_share", "max_repeats").where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("most")).limit(1001).collect()
    if len(wanted) > 1000:
        raise ValueError("targets is a table of settings; it has more than 1000 rows")
    sized = sizes.select(F.col("doc_id").cast("bigint").alias("doc_id"), canonical_source(F.col("source")).alias("source"), F.col("tokens").cast("bigint").alias("tokens"), F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(SEEDS)).alias("seed"))
    names = [r["source"] for r in wanted]
    known = sized.where(F.col("source").isin(*names) & (F.col("tokens") > 0))
    # At most SEEDS rows a target and one for the rest, whatever the number of documents.
    table = sized.where(F.col("tokens") > 0).groupBy(F.when(F.col("source").isin(*names), F.col("source")).alias("source"), F.when(F.col("source").isin(*names), F.col("seed")).alias("seed")).agg(F.sum("tokens").alias("mass"), F.count(F.lit(1)).alias("n")).collect()
    mass = {name: np.zeros(SEEDS) for name in names}
    documents = dict.fromkeys(names, 0)
    total = 0
    for r in table:
        total += r["mass"]
        if r["source"] is not None:
            mass[r["source"]][r["seed"]] += r["mass"]
            documents[r["source"]] += r["n"]
    steps, rates, turns = {}, {}, {}
    for r in wanted:
        most = int(r["most"] or 0)
        turns[r["source"]], rates[r["source"]] = fit_rotation(mass[r["source"]], float(r["share"] or 0) * total, most)
        steps[r["source"]] = poisson_steps(rates[r["source"]], most)
    report = spark.createDataFrame([(r["source"], float(r["share"] or 0), int(r["most"] or 0), documents[r["source"]], int(mass[r["source"]].sum()), total, rates[r["source"]] if math.isfinite(rates[r["source"]]) else None) for r in wanted], "source string, target_share double, max_repeats int, documents bigint, document_tokens bigint, total_tokens bigint, rate double")
    if not names:
        return known.select("source", "doc_id", F.lit(1).alias("copy_no"), "tokens", F.lit(0).cast("bigint").alias("shuffle_key")).limit(0), report.withColumns({"draws": F.lit(0), "drawn_tokens": F.lit(0), "reached_share": F.lit(0.0), "share_of_drawn": F.lit(0.0)})
    # One row a target: its turn of the seeds and its distribution's steps.
    known_steps = F.broadcast(spark.createDataFrame([(name, turns[name], steps[name]) for name in names], "source string, turn int, steps array<double>"))
    turned = (F.pmod(F.col("seed") + F.col("turn"), F.lit(SEEDS)) + 0.5) / SEEDS
    drawn = known.join(known_steps, "source").withColumn("__u", turned).withColumn("times", F.size(F.filter("steps", lambda s: F.col("__u") > s))).where(F.col("times") > 0).drop("turn", "steps", "__u")
    sums = drawn.groupBy("source").agg(F.sum("times").alias("draws"), F.sum(F.col("times") * F.col("tokens")).alias("drawn_tokens"))
    shares = report.join(F.broadcast(sums), "source", "left").withColumns({"draws": F.coalesce("draws", F.lit(0)), "drawn_tokens": F.coalesce("drawn_tokens", F.lit(0))})
    every = sums.agg(F.sum("drawn_tokens").alias("t")).select("t").scalar()
    shares = shares.withColumns({"reached_share": F.try_divide("drawn_tokens", "total_tokens"), "share_of_drawn": F.try_divide(F.col("drawn_tokens"), every)})
    draws = drawn.select("source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy_no"), "tokens").withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.lit("order"), "doc_id", "copy_no"))
    # Keys are even over their range, so equal ranges of it are even partitions: a global order without a look at the rows before.
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = F.floor((F.shiftright("shuffle_key", 11) + F.lit(1 << 52)) * F.lit(parts / float(1 << 53))).cast("int")
    return draws.repartitionById(parts, F.least(F.greatest(place, F.lit(0)), F.lit(parts - 1))).sortWithinPartitions("shuffle_key"), shares
