"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import cut

#: A key is hot from one in MAX_HOT of the rows on, so there can't be more than MAX_HOT of them: the bound of the broadcast.
MAX_HOT = 1000
#: Tables of up to so many rows may go to all tasks (some 20 MB).
MOST_SHARED = 1 << 18


def fence(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once: filters on it aren't pushed below, which would compute it again for each use."""
    return df.withColumn(name, F.explode(F.array(value)))


#: Rows of one key that a task may be given; a hot key is spread over as many tasks as it has such lots.
ROWS_A_TASK = 250_000


def few(df: DataFrame, most: int = MOST_SHARED) -> bool:
    """Whether df has at most `most` rows, so that it may go to all tasks; hand it over stored."""
    return df.limit(most + 1).count() <= most


def hot_keys(df: DataFrame, key: str, max_hot: int = MAX_HOT, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(key, n): the keys that hold at least 1/max_hot of df's non-null keys and more rows than a task should; at most max_hot rows whatever df's size.

    Counts are combined before the shuffle. An empty df, or one with NULL keys only, gives no rows.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.where((F.col("n") > rows_a_task) & (F.col("n") * max_hot >= F.coalesce(total.select("total").scalar(), F.lit(0))))


def salted_lookup(rows: DataFrame, keys: DataFrame, key: str, spread: str, max_hot: int = MAX_HOT, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """rows LEFT JOIN keys USING (key), where hot keys of rows are spread over tasks by a hash of the column spread.

    A hot key has as many salts as it has lots of rows_a_task rows; keys' rows of hot keys are repeated once for each of them, others
    aren't. The broadcast side is the list of hot keys, of at most max_hot rows; without any hot key the join is a plain one. NULL keys match
    nothing and stay, spread by the hash.
    """
    # Stored, as both sides look at it; else the rows would be counted once for each.
    hot = cut(hot_keys(rows, key, max_hot, rows_a_task).select(F.col(key).alias("__hot"), F.ceil(F.col("n") / rows_a_task).cast("int").alias("__salts")))
    if hot.isEmpty():
        return rows.join(keys, key, "left")
    hot = F.broadcast(hot)
    salt = F.pmod(F.xxhash64(spread), F.coalesce("__salts", F.when(F.col(key).isNull(), F.lit(4096)), F.lit(1))).cast("int")
    left = rows.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot", "__salts")
    right = keys.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hot", "__salts")
    return left.join(right, [key, "__salt"], "left").drop("__salt")


def lookup(rows: DataFrame, keys: DataFrame, key: str, spread: str, most: int = MOST_SHARED) -> DataFrame:
    """rows LEFT JOIN keys USING (key): keys of at most `most` rows (counted first) go to all tasks, more are met by salted_lookup."""
    return rows.join(F.broadcast(keys), key, "left") if few(keys, most) else salted_lookup(rows, keys, key, spread)
