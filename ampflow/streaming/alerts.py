"""Alerts on the share of valid sessions while the sessions arrive.

The counts of a day are keyed state; a day's rows of a micro-batch are counted before they are shuffled to it, so a day that
holds most of a batch is no hot key. A row is written whenever a day goes below the threshold (``raised``), when it changes
there (``held``) and when it comes back (``cleared``). The log is written exactly once, also when a batch is repeated.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Worker code travels with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTS = "transaction_date date, total bigint, valid bigint"
LOG = (
    "transaction_date date, total_transactions bigint, valid_transactions bigint, valid_transaction_pct double, event string"
)
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Days of each batch of rows ``(transaction_date, is_valid)`` with their counts."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        valid = pc.cast(pc.fill_null(table.column(1), False), pa.int64())
        table = pa.table({"transaction_date": table.column(0), "valid": valid})
        sums = table.group_by("transaction_date").aggregate([("valid", "count"), ("valid", "sum")])
        yield from sums.select(["transaction_date", "valid_count", "valid_sum"]).rename_columns(
            ["transaction_date", "total", "valid"]
        ).to_batches()


def percent_of(valid: int, total: int) -> float:
    """``100 * valid / total`` rounded half up to 2 decimals, as the daily fact has it."""
    return float(Decimal(repr(100.0 * valid / total)).quantize(Decimal("0.01"), ROUND_HALF_UP))


class DayAlerts(StatefulProcessor):
    """Counts of one day, and whether its alert is on."""

    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("day", "total bigint, valid bigint, raised boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        total, valid, raised = self.state.get() if self.state.exists() else (0, 0, False)
        for frame in rows:
            total, valid = total + int(frame["total"].sum()), valid + int(frame["valid"].sum())
        share = percent_of(valid, total)
        below = share < self.threshold
        self.state.update((total, valid, below))
        if below or raised:
            event = "cleared" if not below else "held" if raised else "raised"
            yield pd.DataFrame(
                {
                    "transaction_date": [key[0]],
                    "total_transactions": [total],
                    "valid_transactions": [valid],
                    "valid_transaction_pct": [share],
                    "event": [event],
                }
            )

    def close(self) -> None:
        pass


def alert_on_new_sessions(
    spark: SparkSession, source: str, schema: str, day: str, valid: str, threshold: float, log: str, checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Reads all files of sessions not read before and appends what happened to the alerts to ``log``, then stops.

    ``day`` and ``valid`` are SQL expressions over the sessions. Rows without a day are no session of a day.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    sessions = reader.parquet(source).selectExpr(f"CAST({day} AS DATE) AS transaction_date", f"CAST({valid} AS BOOLEAN) AS is_valid")
    counts = sessions.where("transaction_date IS NOT NULL").mapInArrow(_counted, COUNTS)
    events = counts.groupBy("transaction_date").transformWithStateInPandas(DayAlerts(threshold), LOG, "Append", "None")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            events.writeStream.format("parquet")
            .outputMode("append")
            .option("path", log)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def open_alerts(spark: SparkSession, log: str) -> DataFrame:
    """The days whose alert is on, as their last row in the log tells. Counts only grow, so the last has the most."""
    rows = spark.read.schema(LOG).parquet(log)
    newest = rows.groupBy("transaction_date").agg(F.max_by(F.struct(*rows.columns[1:]), "total_transactions").alias("last"))
    return newest.select("transaction_date", "last.*").where("event <> 'cleared'").drop("event")
