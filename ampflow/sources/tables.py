"""Table sinks: full-refresh layer tables, and tables written once per run for reuse by later steps."""

from __future__ import annotations

import hashlib
import threading
from collections import defaultdict
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ampflow.session import shared_dir

#: Between the name of a table and the number of a version.
_VERSION = "__v"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}/{database}.db'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def versions_of(spark: SparkSession, database: str, name: str) -> list[int]:
    """Numbers of the versions of a table that are there, oldest first."""
    start = f"{name}{_VERSION}"
    found = [t.name for t in spark.catalog.listTables(database, f"{start}*")]
    return sorted(int(n[len(start) :]) for n in found if n[len(start) :].isdigit())


def save_table(
    df: DataFrame,
    database: str,
    name: str,
    partition_by: Iterable[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
    keep: int = 2,
) -> DataFrame:
    """Full refresh of ``database.name``; returns the table as read back.

    Each refresh writes a table of its own, and the name is a view that is switched to it when all is written. A reader
    sees the old rows or the new ones; one that has begun goes on with the rows it began with, as the last ``keep``
    versions stay. A refresh that dies before the switch changes nothing.

    Facts partition by date so that date filters prune files. Bucketing both sides of the session join by
    ``session_id`` removes its shuffles. Rows are first rebalanced by the layout columns: few files per partition or
    bucket, and one that holds much of the data is still written by several tasks.
    """
    spark = df.sparkSession
    ensure_database(spark, database)
    known = versions_of(spark, database, name)
    version = f"`{database}`.`{name}{_VERSION}{known[-1] + 1 if known else 1}`"
    layout = [*partition_by, *([bucket_by] if bucket_by else [])]
    writer = (df.hint("rebalance", *layout) if layout else df).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(version)
    if any(t.name == name and t.tableType != "VIEW" for t in spark.catalog.listTables(database, name)):
        spark.sql(f"DROP TABLE `{database}`.`{name}`")  # written before tables had versions
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM {version}")
    for old in known[: max(0, len(known) + 1 - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}{_VERSION}{old}`")
    return spark.table(f"`{database}`.`{name}`")


def input_state(spark: SparkSession, paths: Iterable[str]) -> str:
    """Digest of length and modification time of the files under ``paths``."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    seen = []
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        for status in path.getFileSystem(conf).listStatus(path):
            seen.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


class TableStore:
    """Parquet tables in the shared folder, each written once per application and input state.

    Tables are locked one by one, so independent ones can be built at the same time; a build may build others.
    """

    _written: dict[str, StructType] = {}
    _locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)
    _guard = threading.Lock()

    def __init__(self, spark: SparkSession, state: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/ampflow/{spark.sparkContext.applicationId}/{state}"

    def has(self, name: str) -> bool:
        return f"{self.root}/{name}" in self._written

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        with self._guard:
            lock = self._locks[path]
        with lock:
            if path not in self._written:
                built = build()
                built.write.mode("overwrite").parquet(path)
                self._written[path] = built.schema
        return self.spark.read.schema(self._written[path]).parquet(path)
