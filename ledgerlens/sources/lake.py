"""Lake tables: Parquet folders below one root, addressed by name.

Every write of a table goes to a new folder of its own. A commit is one small file that names the
current folder of every table, so several tables change at once or not at all, a run that fails
midway leaves the lake as it was, and a reader keeps the versions it began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import REPORT_TABLES, STATISTICS, TABLES

SPECS = TABLES | STATISTICS


def is_absent(error: AnalysisException) -> bool:
    """Whether reading failed because nothing is there, not because it is broken."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


_COMMIT = "commit bigint, table_name string, folder string"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever file system it is in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Lake:
    """Tables as they were committed when this was made or last refreshed, and its own writes."""

    def __init__(self, spark: SparkSession, root: str | Lake) -> None:
        self.spark = spark
        self.root = (root.root if isinstance(root, Lake) else str(root)).rstrip("/")
        self._commit: int | None = None
        self._folders: dict[str, str] = {}
        self._staged: dict[str, str] | None = None

    @property
    def _commits(self) -> str:
        return f"{self.root}/commits"

    def refresh(self) -> None:
        """Look up the newest commit."""
        try:
            commits = self.spark.read.schema(_COMMIT).parquet(f"{self._commits}/*")
        except AnalysisException as error:
            if not is_absent(error):
                raise
            self._commit, self._folders = 0, {}
            return
        newest = commits.agg(F.max("commit")).scalar()
        rows = commits.filter(F.col("commit") == newest).collect()
        self._commit = max((row["commit"] for row in rows), default=0)
        self._folders = {row["table_name"]: row["folder"] for row in rows}

    def path(self, name: str) -> str:
        """Folder of the current version; without any commit the table's own folder."""
        if self._commit is None:
            self.refresh()
        folder = (self._staged or {}).get(name) or self._folders.get(name)
        base = f"{self.root}/{SPECS[name].path}"
        return f"{base}/{folder}" if folder else base

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """Commit all tables written in the block together; after an error none of them.

        Within another transaction it is part of that one. Two writers must not commit at the same
        time: the later one fails.
        """
        if self._staged is not None:
            yield
            return
        self.refresh()
        self._staged = {}
        try:
            yield
            if self._staged:
                self._write_commit(self._folders | self._staged)
        finally:
            self._staged = None

    def _write_commit(self, folders: dict[str, str]) -> None:
        commit = self._commit + 1
        rows = [(commit, name, folder) for name, folder in sorted(folders.items())]
        # the folder of a commit exists once; writing it again is an error
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("error").parquet(
            f"{self._commits}/{commit:012d}"
        )
        self._commit, self._folders = commit, folders

    def remove_old_versions(self, names: tuple[str, ...] | None = None) -> int:
        """Delete all versions of tables but the current ones; readers of others will fail."""
        self.refresh()
        removed = 0
        for name in names or tuple(SPECS):
            base = f"{self.root}/{SPECS[name].path}"
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(base)
            files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            if not files.exists(folder):
                continue
            for entry in files.listStatus(folder):
                version = entry.getPath().getName()
                if version.startswith("v-") and version != self._folders.get(name):
                    remove_path(self.spark, f"{base}/{version}")
                    removed += 1
        return removed

    def table(self, name: str) -> DataFrame:
        """Read a table; its partition column is always an int, also where Spark infers less."""
        path = self.path(name)
        try:
            df = self.spark.read.parquet(path)
        except AnalysisException as error:
            if is_absent(error):
                raise FileNotFoundError(f"no table {name} in {path}") from error
            raise
        key = SPECS[name].partition_by
        return df.withColumn(key, F.col(key).cast("int")) if key else df

    def has(self, name: str) -> bool:
        try:
            self.table(name)
        except FileNotFoundError:
            return False
        return True

    def missing_tables(self, names: tuple[str, ...] = REPORT_TABLES) -> list[str]:
        return [name for name in names if not self.has(name)]

    def register_views(self) -> list[str]:
        """Make every table that exists a temporary view of the same name."""
        registered = []
        for name in TABLES:
            try:
                self.table(name).createOrReplaceTempView(name)
            except FileNotFoundError:
                continue
            registered.append(name)
        return registered

    def count(self, name: str) -> int:
        """Row count; Spark answers it from the Parquet footers."""
        return self.table(name).count()

    def write(self, df: DataFrame, name: str, rebalance: bool = False) -> DataFrame:
        """Write a new version of a table, its only one from the commit on; return it as read back.

        With rebalance, rows are shuffled by the partition column first; AQE merges small
        partitions and cuts large ones, so a day with a third of all rows still becomes
        many files of normal size. Leave it off where the rows already come day by day.
        """
        with self.transaction():
            key = SPECS[name].partition_by
            if rebalance:
                df = df.hint("rebalance", F.col(key)) if key else df.hint("rebalance")
            writer = df.write
            if key:
                writer = writer.partitionBy(key)
            version = f"v-{uuid.uuid4().hex}"
            path = f"{self.root}/{SPECS[name].path}/{version}"
            writer.parquet(path)
            self._staged[name] = version
        return self.spark.read.schema(df.schema).parquet(path)
