"""Incremental session table: the newest version of each session, merged file by file.

The table is parquet in folders that never change once written, a version that names the folders which make up the table,
and an index of where each key is:

    data/load=<l>/<partition>=<value>/   the rows of a partition, as load ``l`` left them
    index/load=<l>/bucket=<n>/           key, version and partition of the rows whose key falls into a bucket
    versions/<number>.json               which load's folder holds each partition and each bucket, and the batches merged

A batch reads the index buckets of its own keys. They tell which rows are late copies, so that nothing more is read for
them, and which partitions the others were in. Only those partitions, and the ones its rows are in now, are read and
written anew; the other partitions are never scanned. A new version becomes visible by one rename that fails if another
writer was first, so a reader sees the table before or after a batch, never between, and a job that dies before the rename
changes nothing. Newest is decided by the load time, not by the session's start. A batch that was merged already, by its
number in its stream or by its rows, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.session import cut_lineage

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_BUCKET, _PLACE, _SEEN = "_bucket", "_place", "_seen_version"


def newest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the greatest version per key; copies of a key combine before the shuffle.

    Rows of equal version are told apart by their remaining columns, so the result does not depend on row order.
    """
    others = [c for c in df.columns if c not in (key, version)]
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(version, *others)).alias("_row"))
        .select(*[key if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


@dataclass(frozen=True)
class Version:
    """One state of the table: the load that holds each partition and each index bucket, and the last batch of each stream."""

    number: int = -1
    data: dict[str, str] = field(default_factory=dict)
    index: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"data": self.data, "index": self.index, "batches": self.batches}, sort_keys=True)


@dataclass(frozen=True)
class MergeTarget:
    """The table at ``path``; ``buckets`` should let an index bucket hold some million keys."""

    path: str
    schema: str
    key: str = "session_id"
    version: str = "_loaded_at"
    partition: str = "transaction_month"
    buckets: int = 16

    # --- files ---------------------------------------------------------------------------------------------------------

    def _files(self, spark: SparkSession, *parts: str):
        path = spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path, path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, spark: SparkSession, *parts: str) -> list[str]:
        path, files = self._files(spark, *parts)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the versions there are."""
        names = self._names(spark, "versions")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_")]

    def state(self, spark: SparkSession, number: int | None = None) -> Version:
        """The newest version, or the one asked for."""
        known = self.versions(spark)
        if not known:
            return Version()
        number = known[-1] if number is None else number
        # Versions are small: a name for each partition and bucket.
        content = spark.read.text(f"{self.path}/versions/{number:012d}.json", wholetext=True).first()[0]
        return Version(number, **json.loads(content))

    def _publish(self, spark: SparkSession, state: Version) -> None:
        """Makes a version visible; fails if its number is taken."""
        hidden, files = self._files(spark, "versions", f"_{uuid.uuid4().hex}")
        out = files.create(hidden, False)
        out.write(state.text().encode())
        out.close()
        final, _ = self._files(spark, "versions", f"{state.number:012d}.json")
        if files.exists(final):
            raise RuntimeError(f"version {state.number} of {self.path} was written by another merge")
        jvm = spark._jvm
        options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(hidden, final, options)

    def expire(self, spark: SparkSession, keep: int = 2) -> None:
        """Deletes all but the newest versions and the folders that none of them needs; to be run while no merge runs."""
        known = self.versions(spark)
        needed = set()
        for number in known[-keep:]:
            state = self.state(spark, number)
            needed |= {("data", load, f"{self.partition}={value}") for value, load in state.data.items()}
            needed |= {("index", load, f"{_BUCKET}={bucket}") for bucket, load in state.index.items()}
        for number in known[:-keep]:
            path, files = self._files(spark, "versions", f"{number:012d}.json")
            files.delete(path, False)
        for part in ("data", "index"):
            for load in self._names(spark, part):
                held = self._names(spark, part, load)
                unneeded = [n for n in held if (part, load.removeprefix("load="), unquote(n)) not in needed]
                for name in [""] if len(unneeded) == len(held) else unneeded:
                    path, files = self._files(spark, part, load, *filter(None, [name]))
                    files.delete(path, True)

    # --- reading -------------------------------------------------------------------------------------------------------

    def _read(self, spark: SparkSession, part: str, schema: str, folders: list[str]) -> DataFrame:
        columns = spark.createDataFrame([], schema).columns
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*folders).select(*columns)

    def rows(self, spark: SparkSession, state: Version, partitions: Iterable[str]) -> DataFrame:
        """The rows of some partitions; no others are listed or read."""
        jvm = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        wanted = [p for p in partitions if p in state.data]
        folders = [f"{self.path}/data/load={state.data[p]}/{self.partition}={jvm.escapePathName(p)}" for p in wanted]
        return self._read(spark, "data", self.schema, folders)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table as of its newest version, or of an earlier one that is still there."""
        state = self.state(spark, version)
        return self.rows(spark, state, state.data)

    def places(self, spark: SparkSession, state: Version, buckets: Iterable[str]) -> DataFrame:
        """The index entries of some buckets: key, version and partition."""
        fields = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], self.schema).schema.fields}
        schema = f"{self.key} {fields[self.key]}, {_SEEN} {fields[self.version]}, {_PLACE} string, {_BUCKET} int"
        folders = [f"{self.path}/index/load={state.index[b]}/{_BUCKET}={b}" for b in buckets if b in state.index]
        return self._read(spark, "index", schema, folders)

    # --- merging -------------------------------------------------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _place(self):
        return F.coalesce(F.col(self.partition).cast("string"), F.lit(_NO_VALUE))

    def _of_keys(self, df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        wanted = keys.select(F.col(self.key).alias("_wanted"))
        return df.join(wanted, df[self.key].eqNullSafe(wanted["_wanted"]), how)

    def _values(self, df: DataFrame, column: str) -> set[str]:
        """Distinct partitions or buckets: at most some thousands."""
        return {str(r[0]) for r in df.select(column).distinct().collect()}

    def news(self, batch: DataFrame, state: Version) -> tuple[DataFrame, DataFrame]:
        """Rows of a batch that the table does not outdate, with the partition that holds their key; and the index read for them."""
        spark = batch.sparkSession
        columns = [f.name for f in spark.createDataFrame([], self.schema).schema.fields]
        fresh = newest_per_key(batch.select(*columns), self.key, self.version)
        fresh = cut_lineage(fresh.withColumn(_BUCKET, self._bucket()))
        known = self.places(spark, state, sorted(self._values(fresh, _BUCKET)))
        own = known.withColumnsRenamed({self.key: "_known", _BUCKET: "_known_bucket"})
        same = (fresh[_BUCKET] == own["_known_bucket"]) & fresh[self.key].eqNullSafe(own["_known"])
        met = fresh.join(own, same, "left").drop("_known", "_known_bucket")
        return cut_lineage(met.where(F.col(_SEEN).isNull() | (F.col(self.version) >= F.col(_SEEN)))), known

    def merge(self, batch: DataFrame, number: int | None = None, stream: str = "") -> None:
        """Fold one batch into the table; batch ``number`` of a stream is merged once."""
        spark = batch.sparkSession
        state = self.state(spark)
        if number is not None and state.batches.get(stream, -1) >= number:
            return
        news, known = self.news(batch, state)
        batches = state.batches if number is None else state.batches | {stream: number}
        after = replace(state, number=state.number + 1, batches=batches)
        # Partitions and buckets: at most some thousands each.
        met = news.agg(F.collect_set(_PLACE), F.collect_set(self._place()), F.collect_set(_BUCKET)).first()
        touched, buckets = {*met[0], *met[1]}, sorted(met[2])
        if touched:
            load = f"{after.number:012d}-{uuid.uuid4().hex[:8]}"
            old = self.rows(spark, state, sorted(touched))
            rows = news.select(*old.columns)
            # Only rows of the batch's keys compete; all others of their partitions pass by.
            winners = newest_per_key(self._of_keys(old, news, "left_semi").unionByName(rows), self.key, self.version)
            winners = cut_lineage(winners)
            kept = self._of_keys(old, news, "left_anti").unionByName(winners)
            # Rebalancing gives each partition few files and still splits one that holds much of the data.
            kept.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/data/load={load}")
            entries = winners.select(
                self.key, F.col(self.version).alias(_SEEN), self._place().alias(_PLACE), self._bucket().alias(_BUCKET)
            )
            stay = self._of_keys(known.where(F.col(_BUCKET).isin(buckets)), news, "left_anti")
            stay.unionByName(entries).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/index/load={load}")
            written = {unquote(n.split("=", 1)[1]) for n in self._names(spark, "data", f"load={load}") if "=" in n}
            data = {p: at for p, at in state.data.items() if p not in touched} | dict.fromkeys(written, load)
            after = replace(after, data=data, index=state.index | dict.fromkeys(map(str, buckets), load))
        if touched or after.batches != state.batches:
            self._publish(spark, after)


def merge_new_files(
    spark: SparkSession, source: str, target: MergeTarget, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Merge all files not merged before, in micro-batches, then stop."""
    reader = spark.readStream.schema(target.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(lambda batch, number: target.merge(batch, number, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
