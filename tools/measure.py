"""Wall time, shuffle bytes and stage balance of registered queries, from Spark's event log.

    python tools/measure.py [--sf 0.1] [name ...]

Each query runs twice; the second run is reported. ``slowest`` is the longest task of the run, ``rows`` the largest
number of rows one task read.
"""

from __future__ import annotations

import argparse
import json
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ampflow.catalog import QUERIES  # noqa: E402
from ampflow.plans.warehouse import LAYERS, Warehouse  # noqa: E402
from ampflow.session import build_session  # noqa: E402


def run(sf_dir: str, names: list[str], log: str) -> dict[str, float]:
    spark = build_session(
        "ampflow-measure",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    warehouse = Warehouse(spark, sf_dir)
    for table in LAYERS:
        warehouse.table(table)
    seconds = {}
    for name in names:
        for attempt in ("first", "second"):
            spark.sparkContext.setJobGroup(f"{attempt}:{name}", name)
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = time.perf_counter() - start
    spark.stop()
    return seconds


def totals(log: str) -> dict[str, dict[str, int]]:
    """Per job group: shuffle bytes written, stages, slowest task in ms, most rows read by a task."""
    group_of: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in Path(log).rglob("*"):
        if not path.is_file():
            continue
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id", "")
                for stage in event["Stage IDs"]:
                    group_of[stage] = group
            elif event["Event"] == "SparkListenerStageCompleted":
                out[group_of.get(event["Stage Info"]["Stage ID"], "")]["stages"] += 1
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                metrics, mine = event["Task Metrics"], out[group_of.get(event["Stage ID"], "")]
                mine["shuffle_bytes"] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                mine["slowest_ms"] = max(mine["slowest_ms"], metrics["Executor Run Time"])
                read = (
                    metrics["Input Metrics"]["Records Read"] + metrics["Shuffle Read Metrics"]["Total Records Read"]
                )
                mine["rows"] = max(mine["rows"], read)
    return out


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.1")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    log = tempfile.mkdtemp(prefix="run-")
    seconds = run(f"/root/testdata/sf{args.sf}", args.names or list(QUERIES), log)
    measured = totals(log)
    print("| query | sec | shuffle KB | stages | slowest ms | rows |\n|---|---|---|---|---|---|")
    for name, sec in seconds.items():
        m = measured[f"second:{name}"]
        print(
            f"| {name} | {sec:.2f} | {m['shuffle_bytes'] / 1024:.0f} | {m['stages']} | {m['slowest_ms']} | {m['rows']} |"
        )


if __name__ == "__main__":
    main()
