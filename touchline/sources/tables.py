"""JDBC scan, materialisation, versioned tables and copy checks."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_jdbc(
    spark: SparkSession, url: str, table: str, options: dict[str, str],
    partition_column: str | None = None, lower: int | None = None, upper: int | None = None, partitions: int = 16,
) -> DataFrame:
    """Table scan over JDBC, split on a numeric or date column when one is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return reader.load()


def replace_table(df: DataFrame, table: str) -> None:
    """Full replace of a table, a new snapshot where its catalog is a lakehouse catalog.

    A name without a configured catalog is a table of the session catalog and is overwritten there.
    """
    spark = df.sparkSession
    catalog = table.split(".")[0]
    if spark.conf.get(f"spark.sql.catalog.{catalog}", None):
        df.writeTo(table).createOrReplace()
    else:
        df.write.mode("overwrite").saveAsTable(table)


def materialize(df: DataFrame, table: str, as_view: bool = False) -> None:
    """Rebuild a model as a table, or expose it as a view."""
    if as_view:
        df.createOrReplaceTempView(table)
    else:
        df.write.mode("overwrite").saveAsTable(table)


def verify_counts(source: DataFrame, target: DataFrame) -> int:
    """Raise unless both sides have the same number of rows (counted in one job)."""
    a = source.agg(F.count(F.lit(1)).alias("a"))
    b = target.agg(F.count(F.lit(1)).alias("b"))
    row = a.crossJoin(F.broadcast(b)).first()
    if row["a"] != row["b"]:
        raise RuntimeError(f"Row count mismatch: source={row['a']}, target={row['b']}")
    return row["a"]


COMMIT = "committed_at TIMESTAMP, version BIGINT, operation STRING, data STRING, summary MAP<STRING,STRING>"


class VersionTaken(RuntimeError):
    """Another writer has committed the version that this one prepared."""


class CommitLog:
    """One small file per committed version, created exclusively: of two writers that prepare a version only one gets it.

    Holds where the file system refuses to create a file that exists (HDFS does; on stores without that, keep to one writer).
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, sub: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def snapshots(self) -> DataFrame:
        """committed_at, version, operation, data folder and summary of every commit."""
        fs, folder = self._place("_commits")
        if not fs.exists(folder):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(f"{self.path}/_commits")

    def latest_version(self) -> int | None:
        return self.snapshots().agg(F.max("version")).first()[0]

    def first_version(self) -> int | None:
        return self.snapshots().agg(F.min("version")).first()[0]

    def has(self, operation: str) -> bool:
        return not self.snapshots().filter(F.col("operation") == operation).isEmpty()

    def claim(self, version: int, operation: str, data: str, summary: dict[str, int]) -> int:
        """Commit ``version``; raises ``VersionTaken`` if it exists."""
        fs, file = self._place(f"_commits/{version:012d}.json")
        now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        entry = {"committed_at": now, "version": version, "operation": operation, "data": data, "summary": {k: str(v) for k, v in summary.items()}}
        try:
            out = fs.create(file, False)
        except Py4JJavaError as error:
            if fs.exists(file):
                raise VersionTaken(f"version {version} below {self.path} is taken") from error
            raise
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        return version


class VersionedTable(CommitLog):
    """Parquet versions below one folder with a commit log, for storage without table snapshots.

    A version is written completely, into a folder of its own, before its commit appears, and no version is ever changed, so
    a run can read the current version while it writes the next.
    """

    def commit(self, df: DataFrame, operation: str = "replace") -> int:
        """Write ``df`` as the next version."""
        version, data = (self.latest_version() or 0) + 1, f"data-{uuid.uuid4().hex}"
        written = Observation()
        df.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{data}")
        n = written.get["n"]
        return self.claim(version, operation, data, {"added-records": n, "total-records": n})

    def read(self, version: int | None = None) -> DataFrame:
        """The given version, or the current one."""
        wanted = self.snapshots() if version is None else self.snapshots().filter(F.col("version") == version)
        found = wanted.orderBy(F.col("version").desc()).select("data").first()
        if found is None:
            raise ValueError(f"no such version committed below {self.path}")
        return self.spark.read.parquet(f"{self.path}/{found.data}")

    def files(self, version: int | None = None) -> DataFrame:
        """Data files of a version with their row count and size."""
        rows = self.read(version).select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes")
        )
        return rows.groupBy("file_path", "file_size_in_bytes").agg(F.count(F.lit(1)).alias("record_count"))


class HistoryTable(CommitLog):
    """Type-2 history in two parts: closed versions are only ever appended, open ones are replaced by each commit.

    A commit writes one folder with the versions that it closes and all open ones, each in a partition of its own. The history
    of a version is the open part of its commit and the closed parts of all commits up to it, so a run costs the open rows
    whatever the length of the history.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        """``schema`` lists the history's columns, ``valid_from`` and ``valid_to`` included."""
        super().__init__(spark, path)
        self.schema = schema

    def _part(self, is_open: bool, data: list[str]) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, `_commit` string, `_open` boolean")
        if not data:
            return self.spark.createDataFrame([], self.schema)
        mine = rows.parquet(f"{self.path}/data").filter(F.col("_commit").isin(data) & (F.col("_open") == is_open))
        return mine.drop("_commit", "_open")

    def _commits(self, version: int | None) -> list:
        found = self.snapshots() if version is None else self.snapshots().filter(F.col("version") <= version)
        return found.orderBy("version").select("version", "data").collect()

    def open_rows(self, version: int | None = None) -> DataFrame:
        """Open versions only: one partition of one commit is read."""
        return self._part(True, [r.data for r in self._commits(version)[-1:]])

    def read(self, version: int | None = None) -> DataFrame:
        """The whole history as of a commit, or now."""
        commits = [r.data for r in self._commits(version)]
        return self._part(False, commits).unionByName(self._part(True, commits[-1:]))

    def commit(self, base: int | None, versions: DataFrame, operation: str) -> int:
        """Commit ``versions`` (rows closed by this run and all open rows), prepared on version ``base``, as the next one."""
        data = uuid.uuid4().hex
        marked = versions.withColumn("_open", F.col("valid_to").isNull())
        written = Observation()
        counted = marked.observe(written, F.count(F.lit(1)).alias("n"), F.count_if("_open").alias("opened"))
        # a folder per commit, written whole before the commit names it
        counted.write.partitionBy("_open").parquet(f"{self.path}/data/_commit={data}")
        n, opened = written.get["n"], written.get["opened"]
        return self.claim((base or 0) + 1, operation, data, {"closed-records": n - opened, "open-records": opened})


def snapshot_summary(snapshots: DataFrame) -> DataFrame:
    """Commits in order with their record counts looked up in the summary map."""
    return snapshots.select(
        "committed_at", "version", "operation",
        F.element_at("summary", "added-records").alias("added_records"),
        F.element_at("summary", "total-records").alias("total_records"),
    ).orderBy("committed_at", "version")
