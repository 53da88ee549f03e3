from __future__ import annotations

import os
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark import TaskContext

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from creditloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    warehouse = tmp_path_factory.mktemp("warehouse")
    # Two attempts per task, for the tests that make one fail.
    session = local_session(
        "8,2", spark__checkpoint__dir=str(shared), spark__sql__warehouse__dir=str(warehouse)
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_all(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


USAGE = (
    "user_name string, warehouse_name string, start_time timestamp_ntz, execution_time bigint,"
    " total_elapsed_time bigint, query_text string"
)
METERING = "warehouse_name string, start_time timestamp_ntz, credits_used decimal(18,9)"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def executed_plan(df) -> str:
    """The final plan, after the adaptive re-planning of a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def failing_once(df, partition: int):
    """``df``, whose task ``partition`` fails at its first attempt after reading all its rows."""

    def read(batches):
        yield from batches
        context = TaskContext.get()
        if context.partitionId() == partition and context.attemptNumber() == 0:
            raise RuntimeError("lost on purpose")

    return df.mapInArrow(read, df.schema)
