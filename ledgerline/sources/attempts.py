"""What a series of HTTP attempts comes to: retries, backoff and classification as folds over a log of attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repo_outcome(status: Column, remaining: Column) -> Column:
    """What one attempt at a repository tells: a final api_status, or `retry:` and the status it would end in."""
    return (
        F.when(status == 200, "OK")
        .when(status == 404, "NOT_FOUND")
        .when((status == 429) | ((status == 403) & (remaining == "0")), "retry:RATE_LIMITED")
        .when(status.isNull() | (status >= 500), "retry:ERROR")
        .otherwise("ERROR")
    )


def page_outcome(status: Column) -> Column:
    """What one attempt at a page tells: OK, ERROR without a retry, or a retry that ends in TIMEOUT."""
    return F.when(status.isNull() | (status == 429) | (status >= 500), "retry:TIMEOUT").when(status >= 400, "ERROR").otherwise("OK")


def provider_outcome(status: Column) -> Column:
    """What one attempt at an extraction provider tells: OK, ERROR without a retry, or a retry that ends in ERROR."""
    return F.when(status.isNull() | status.isin(429, 500, 502, 503, 504), "retry:ERROR").when(status >= 400, "ERROR").otherwise("OK")


def backoff(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """Seconds waited after a failed attempt (from 1), without jitter."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def provider_wait(status: Column, attempt: Column, retry_after: Column) -> Column:
    """Seconds waited after an attempt (from 1) at an extraction provider, without jitter; NULL where there is no other try.

    429: what the server asks for, 2 if that can't be read, else doubling from 1; 30 at most. Others that are tried again: doubling from 1, 10 at most.
    """
    doubled = F.pow(F.lit(2.0), attempt - 1)
    asked = F.when(retry_after.isNull() | (retry_after == ""), doubled).otherwise(F.coalesce(F.try_to_number(retry_after, F.lit("999999D999")).cast("double"), F.expr("2.0D")))
    return F.when(status == 429, F.least(asked, F.lit(30.0))).when(status.isNull() | status.isin(500, 502, 503, 504), F.least(doubled, F.lit(10.0)))


def fold_attempts(log: DataFrame, key: str, order: str, outcome: Column, max_attempts: int = 5, base: float = 1.0, most: float = 60.0) -> DataFrame:
    """(key, attempts_used, api_status, waited): each key's attempts in order, up to the first final one or max_attempts.

    waited is the backoff between the attempts used; there is none after the last. A key whose log ends early, all retries, is judged by
    what there is. NULL keys are left out. Only the first max_attempts rows of a key are kept, in each task before the shuffle
    (a ranked limit), so a key with many rows is no burden.
    """
    ranked = log.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(order).alias("__at"), outcome.alias("__o"))
    ranked = ranked.withColumn("__n", F.row_number().over(Window.partitionBy("__key").orderBy("__at", "__o"))).where(F.col("__n") <= max_attempts)
    final = ~F.col("__o").startswith("retry:")
    seen = ranked.groupBy("__key").agg(F.min(F.when(final, F.col("__n"))).alias("__final"), F.max("__n").alias("__last"), F.collect_list(F.struct("__n", "__o")).alias("__all"))
    used = F.coalesce("__final", "__last")
    text = F.filter("__all", lambda a: a["__n"] == used)[0]["__o"]
    waits = F.aggregate(F.sequence(F.lit(1), F.lit(max_attempts)), F.lit(0.0), lambda total, k: total + F.when(k < used, backoff(k.cast("double"), base, most)).otherwise(0.0))
    return seen.select(F.col("__key").alias(key), used.cast("int").alias("attempts_used"), F.regexp_replace(text, "^retry:", "").alias("api_status"), waits.alias("waited"))
