"""A store of table snapshots on files: append, insert if absent, upsert; readers always see one whole version."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import relational
from ledgerline.schemas import TABLES, schema


#: Folders of one table from which on an append joins some.
MOST_FOLDERS = 32


class SnapshotStore:
    """Tables as folders <root>/<table>/v=<n> and lists current-<n> of the folders that make up version n; for one writing job at a time.

    A change writes a new folder and then its list, so a path that is being read is never overwritten and a job that dies leaves the
    old version current. Appending and inserting write the new rows only, however large the table is; when a table has MOST_FOLDERS folders, the
    next append takes the rows of the later half with it, so that readers never list many and old rows are rarely written anew. compact joins
    all. Files go through Hadoop's file system, so root may be any shared folder.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def version(self, table: str) -> int:
        """The current version, 0 if the table was never written."""
        found = self._files().globStatus(self._path(f"{self.root}/{table}/current-*")) or []
        return max((int(s.getPath().getName().rpartition("-")[2]) for s in found), default=0)

    def _folders(self, table: str) -> list[int]:
        """The folders of the current version."""
        n = self.version(table)
        return json.loads(self.spark.read.text(f"{self.root}/{table}/current-{n}", wholetext=True).first()[0]) if n else []

    def read(self, table: str) -> DataFrame:
        """The current version; an empty table of the right schema if it was never written."""
        folders = self._folders(table)
        return self._of(table, folders) if folders else self.spark.createDataFrame([], schema(table))

    def _of(self, table: str, folders: list[int]) -> DataFrame:
        return self.spark.read.schema(schema(table)).parquet(*(f"{self.root}/{table}/v={n}" for n in folders))

    def _write(self, table: str, rows: DataFrame, before: list[int]) -> int:
        n = self.version(table) + 1
        rows.select(*schema(table).fieldNames()).write.mode("overwrite").parquet(f"{self.root}/{table}/v={n}")
        out = self._files().create(self._path(f"{self.root}/{table}/current-{n}"), True)
        out.writeBytes(json.dumps([*before, n]))
        out.close()
        return n

    def publish(self, table: str, df: DataFrame) -> int:
        """df becomes the table; returns its version."""
        return self._write(table, df, [])

    def migrate(self) -> None:
        """Writes an empty version of each table that has none; running it again changes nothing."""
        for table in TABLES:
            if not self.version(table):
                self.publish(table, self.spark.createDataFrame([], schema(table)))

    def append(self, table: str, rows: DataFrame) -> int:
        """Adds rows; columns they lack are NULL."""
        empty, folders = self.spark.createDataFrame([], schema(table)), self._folders(table)
        rows, kept = relational.append(empty, rows), len(folders)
        if kept >= MOST_FOLDERS:
            kept //= 2
            rows = rows.unionByName(self._of(table, folders[kept:]))
        return self._write(table, rows, folders[:kept])

    def put_if_absent(self, table: str, rows: DataFrame, key: list[str]) -> int:
        """Adds the rows whose key the table lacks."""
        return self.append(table, relational.absent(self.read(table), rows, key))

    def replace(self, table: str, rows: DataFrame, key: list[str], order: str) -> int:
        """Puts rows in place of those with the same key; writes the table anew."""
        return self.publish(table, relational.last_writer_wins(self.read(table), rows, key, order))

    def compact(self, table: str) -> int:
        """The same rows in one folder."""
        return self.publish(table, self.read(table))
