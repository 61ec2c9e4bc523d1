"""Flat sheets: rows of text in a fixed order of columns, written whole each time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.schemas import EXPORT_FIELDS
from ledgerline.session import cut


#: Texts with line ends, quotes and spaces come back as they were.
_FORM = {"header": "true", "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "lineSep": "\n"}
#: Rows that fit a spreadsheet: one file, written by one task.
SHEET_ROWS = 1_000_000


def sheet_rows(exports: DataFrame) -> DataFrame:
    """The export fields as text in their fixed order: lists joined by "; " (NULL elements left out), NULL as ''."""
    kinds = dict(exports.dtypes)
    text = lambda f: F.array_join(f, "; ") if kinds[f].startswith("array") else F.col(f).cast("string")
    return exports.select(*(c for c in exports.columns if c not in EXPORT_FIELDS), *(F.coalesce(text(f), F.lit("")).alias(f) for f in EXPORT_FIELDS))


def chunked(rows: DataFrame, order: list[str], size: int = 500) -> DataFrame:
    """rows with chunk: which request of `size` rows carries it; the header is the first row of chunk 0.

    A sheet is one numbered list, and its size is bounded by the sheet service; the numbering is exact over a total order. It is done in two
    steps: counts of the range-partitioned rows give each partition's first number, so no task holds more than its range.
    """
    # Stored once: ranges are sampled, and another evaluation could draw them elsewhere.
    ranged = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row a partition: a window over the partitions, not over the rows.
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__part", "__before")
    numbered = ranged.withColumn("__no", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return numbered.join(F.broadcast(before), "__part").withColumn("chunk", F.floor((F.col("__before") + F.col("__no")) / size).cast("int")).drop("__part", "__no", "__before")


def write_sheet(rows: DataFrame, path: str | None, sheet_id: str | None, most: int = SHEET_ROWS) -> None:
    """The whole sheet anew at path/sheet_id, with a header. Both must be named.

    A sheet of at most `most` rows, which is what a spreadsheet can show, is one file; a larger one has as many files as ranges of its
    order, each with the header, whose names follow the order.
    """
    if not path or not sheet_id:
        raise ValueError("a sheet needs a place and an id")
    rows = cut(rows)
    if rows.count() <= most:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").options(**_FORM).csv(f"{path.rstrip('/')}/{sheet_id}")


def read_sheet(spark: SparkSession, path: str, sheet_id: str) -> DataFrame:
    """A sheet as it was written: all text, NULL nowhere."""
    return spark.read.options(**_FORM, multiLine="true").csv(f"{path.rstrip('/')}/{sheet_id}").na.fill("")
