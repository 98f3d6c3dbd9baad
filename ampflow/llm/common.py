"""Helpers of the pipeline operators: inputs, tables written once, and code that runs in Python workers."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import ampflow.llm
from ampflow.session import shared_dir

# Worker code travels with the tasks, so a cluster needs no installed copy of this package.
cloudpickle.register_pickle_by_value(ampflow.llm)

#: Bounds of an Arrow batch: long texts make a batch large, so there are fewer rows than Spark's default.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
#: Bytes of text that one step of worker code holds at a time, except for a single longer text.
CHUNK_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Any path Spark can read; nothing is opened outside Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder of this application in the shared folder."""
    return f"{shared_dir(spark)}/ampflow-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, and there when an executor is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(
    df: DataFrame, worker: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(worker, schema)


def chunks(batches: Iterator[pa.RecordBatch], column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``limit`` bytes, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        per_row = max(1, batch.column(column).nbytes // batch.num_rows)
        step = max(1, limit // per_row)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker builds once and keeps for its later tasks."""
    held = sys.__dict__.setdefault("_ampflow_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))
