"""The hourly rollup of the usage history: a table that reports read instead of the raw history.

A row per user, pool and hour, partitioned by day. Days are written anew as a whole, so a day may be
refreshed any number of times, while its queries still come in or after they were corrected, and a run that
fails leaves the days as they were.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.dates import month_before
from creditloom.sources.log_table import replace_partitions

COLUMNS = (
    "user_name string, warehouse_name string, start_hour timestamp_ntz, user_time bigint,"
    " time_on_the_hour bigint, day date"
)


def create_rollup(spark: SparkSession, name: str | None = None) -> str:
    """Create an empty rollup, managed by the catalog, and return its full name."""
    name = name or f"spark_catalog.default.usage_hours_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet PARTITIONED BY (day)")
    return name


@contextmanager
def passing_rollup(spark: SparkSession) -> Iterator[str]:
    """A rollup that is dropped, with its files, at the end of the block."""
    name = create_rollup(spark)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def refresh(name: str, usage: DataFrame, first: date, last: date) -> None:
    """Write the days from ``first`` to ``last`` anew from the raw history.

    Only these days of ``usage`` are read. ``time_on_the_hour`` is the time of queries that start exactly
    on the hour, which a period that begins there leaves out. A day without any query that counts keeps
    what it has; a history only loses a day by ``drop_days``.
    """
    day = F.to_date("start_time")
    hour = F.date_trunc("hour", "start_time")
    on_the_hour = F.when(F.col("start_time") == hour, F.col("execution_time")).otherwise(0)
    rows = (
        usage.filter((day >= F.lit(first)) & (day <= F.lit(last)))
        .filter(F.col("warehouse_name").isNotNull() & (F.col("execution_time") > 0))
        .groupBy("user_name", "warehouse_name", hour.cast("timestamp_ntz").alias("start_hour"))
        .agg(
            F.sum("execution_time").alias("user_time"),
            F.sum(on_the_hour).alias("time_on_the_hour"),
        )
        .withColumn("day", F.to_date("start_hour"))
    )
    columns = [field.split()[0] for field in COLUMNS.split(", ")]
    # By day, so that a task writes few files; a day of very many rows is split by size.
    replace_partitions(name, rows.select(*columns).hint("rebalance", F.col("day")))


def drop_days(spark: SparkSession, name: str, *days: date) -> None:
    for day in days:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (day = DATE '{day.isoformat()}')")


def hours_since(rollup: DataFrame, as_of: datetime) -> DataFrame:
    """``user_hours`` of the month up to ``as_of``, a full hour, from the rollup.

    The period begins after that moment, so what started exactly on its first hour is left out. Only the
    days of the period are read. Within an hour the rollup cannot be cut.
    """
    if (as_of.minute, as_of.second, as_of.microsecond) != (0, 0, 0):
        raise ValueError("the rollup answers for full hours")
    since = month_before(as_of, rollup, "start_hour")
    hours = rollup.filter((F.col("day") >= F.to_date(since)) & (F.col("start_hour") >= since))
    first = F.col("start_hour") == since
    spent = F.col("user_time") - F.when(first, F.col("time_on_the_hour")).otherwise(0)
    return hours.select(
        "user_name", "warehouse_name", "start_hour", spent.alias("user_time")
    ).filter("user_time > 0")
