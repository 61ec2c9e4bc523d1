"""Validity periods of changing attributes: gaps and islands without a window over a whole hot entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.urls import repo_url
from ledgerline.session import cut


def change_history(df: DataFrame, key: str, time: str, attributes: Sequence[str], block: str = "hour") -> DataFrame:
    """One row for each version of each entity: key, version (from 1), the attributes, valid_from, valid_to (exclusive, NULL for the last).

    A hash of the attributes is compared with that of the reading before (lag); a running sum of the changes numbers the
    islands; valid_from is an island's earliest time, valid_to the next one's. Two levels keep hot entities apart: readings are
    compared within one entity and one `block` of time ("hour", "day" ..); then one summary row a block (first and last state,
    islands) is compared across blocks of the entity, and its outcome is joined back. No task holds more of an entity than one
    block's readings or one row for each block of time, even if an entity has a third of all readings and changes at every one.
    df is read once: the islands, each with its block's summary, are stored in the shared folder.

    Rows without key or time are left out; NULL attributes are values like any other. Different states at one instant are put
    in order by their hash, equal ones count once. An empty df gives no rows. Columns besides those named are ignored.
    """
    kinds = dict(df.dtypes)
    # Hashes skip NULLs, so each value goes with a mark; values with parts go as JSON, which marks those within.
    plain = lambda a: F.to_json(F.struct(F.col(a).alias("v")), {"ignoreNullFields": "false"}) if kinds[a].startswith(("array", "struct", "map")) else F.col(a)
    state = F.xxhash64(*(c for a in attributes for c in (F.col(a).isNull(), plain(a))))
    readings = (
        df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        .select(F.col(key).alias("__key"), F.date_trunc(block, time).alias("__block"), F.col(time).alias("__time"), state.alias("__state"), *(F.col(a).alias(f"__a{k}") for k, a in enumerate(attributes)))
        .repartition("__key", "__block")
    )
    inside = Window.partitionBy("__key", "__block").orderBy("__time", "__state")
    upwards = Window.partitionBy("__key", "__block").orderBy("__island")
    whole = upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    islands = cut(
        readings.withColumn("__before", F.lag("__state").over(inside))
        .withColumn("__starts", (~F.col("__before").eqNullSafe(F.col("__state"))).cast("long"))
        .withColumn("__island", F.sum("__starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("__starts") == 1)
        .drop("__before", "__starts")
        .withColumn("__lead", F.lead("__time").over(upwards))
        .withColumn("__last_state", F.last("__state").over(whole))
        .withColumn("__islands", F.max("__island").over(whole))
        .withColumn("__first", F.col("__island") == 1)
    )
    blocks = islands.where("__first").select("__key", "__block", F.col("__state").alias("__first_state"), "__last_state", F.col("__time").alias("__first_time"), F.col("__lead").alias("__second_time"), "__islands")
    forward, backward = Window.partitionBy("__key").orderBy("__block"), Window.partitionBy("__key").orderBy(F.desc("__block"))
    # A block's first island goes on with the version before it if the block before ended in the same state.
    linked = (
        blocks.withColumn("__goes_on", F.lag("__last_state").over(forward).eqNullSafe(F.col("__first_state")).cast("long"))
        .withColumn("__own", F.when(F.col("__goes_on") == 1, F.col("__second_time")).otherwise(F.col("__first_time")))
        .withColumn("__passed", F.coalesce(F.sum(F.col("__islands") - F.col("__goes_on")).over(forward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("__next", F.last("__own", ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1)))
        .select("__key", "__block", "__goes_on", "__passed", "__next")
    )
    return (
        islands.join(linked, ["__key", "__block"])
        .where(F.col("__island") > F.col("__goes_on"))
        .select(F.col("__key").alias(key), (F.col("__passed") + F.col("__island") - F.col("__goes_on")).alias("version"), *(F.col(f"__a{k}").alias(a) for k, a in enumerate(attributes)), F.col("__time").alias("valid_from"), F.coalesce("__lead", "__next").alias("valid_to"))
    )


def repository_history(snapshots: DataFrame, host: str = "codeforge.example") -> DataFrame:
    """Versions of (gone, stargazers_count) of each repository, over every reading that tells a state.

    An OK reading with a count tells that count, a NOT_FOUND one that the repository is gone; others tell nothing. Repeated rows
    tell the same state at the same time, so they count once; URLs are compared in canonical form, rows whose URL names no
    repository are left out.
    """
    ok = F.col("api_status") == "OK"
    readings = snapshots.where((ok & F.col("stargazers_count").isNotNull()) | (F.col("api_status") == "NOT_FOUND")).select(
        F.explode(F.array(repo_url(F.col("repo_url"), host, reserved=()))).alias("repo_url"), "stars_fetched_at", (~ok).alias("gone"), F.when(ok, F.col("stargazers_count")).alias("stargazers_count")
    )
    return change_history(readings, "repo_url", "stars_fetched_at", ["gone", "stargazers_count"])
