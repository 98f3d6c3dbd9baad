from __future__ import annotations

import os
import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ampflow.config import Run  # noqa: E402
from ampflow.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "ampflow-tests",
        f"local[{min(8, os.cpu_count() or 1)}]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.checkpoint.dir": str(scratch / "shared"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def run():
    return Run(as_of=date(2025, 6, 1), run_ts=datetime(2025, 6, 1, 8, 30))


def values(df, *columns):
    """Rows as plain tuples, in a stable order."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
