"""One repository for each paper, or none: the strongest evidence decides, ambiguity is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def select_primary(candidates: DataFrame, group: str, row: str) -> DataFrame:
    """(group, n_best, n_official, selected): the chosen candidate's row id for each group with candidates, NULL if it stays ambiguous.

    Candidates of the least evidence_strength count, by row: exactly one is chosen; else, if exactly one of them has "official" in its
    evidence_locator (any letter case), that one; else none. NULL locators aren't official; NULL strengths count only where all are
    NULL; NULL groups are left out. Two aggregations with partial results, no window: a hot group sends one row a task.
    """
    official = F.coalesce(F.contains(F.lower("evidence_locator"), F.lit("official")), F.lit(False))
    # Per group and strength first, then the least strength of each group; both combine before they shuffle.
    by = candidates.where(F.col(group).isNotNull()).groupBy(group, "evidence_strength").agg(
        F.count(F.lit(1)).alias("n_best"), F.count_if(official).alias("n_official"), F.min(row).alias("__only"), F.min(F.when(official, F.col(row))).alias("__official")
    )
    best = by.groupBy(group).agg(F.min_by(F.struct("n_best", "n_official", "__only", "__official"), F.coalesce("evidence_strength", F.lit(2**31 - 1))).alias("b"))
    return best.select(group, "b.n_best", "b.n_official", F.when(F.col("b.n_best") == 1, F.col("b.__only")).when(F.col("b.n_official") == 1, F.col("b.__official")).alias("selected"))


def mark_selected(links: DataFrame, chosen: DataFrame) -> DataFrame:
    """links with is_selected true on the chosen rows (column selected), false elsewhere; repeated rows of a chosen id are all marked."""
    picks = chosen.where(F.col("selected").isNotNull()).select(F.col("selected").alias("__pick")).distinct()
    return links.join(picks, links["id"] == picks["__pick"], "left").withColumn("is_selected", F.col("__pick").isNotNull()).drop("__pick")


def selected_twice(links: DataFrame) -> DataFrame:
    """Papers with more than one selected link id: the rule that none may exist, as a query."""
    return links.where(F.col("is_selected")).groupBy("paper_id").agg(F.count_distinct("id").alias("n")).where(F.col("n") > 1)


def first_of_each(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") == 1).drop("__n")
