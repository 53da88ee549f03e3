"""The credit log: a catalog table that reports append to and read back.

Names are written in full (``catalog.schema.table``). Appends go through Spark's table commit, so a
lost executor leaves no partial rows behind. A report that may run twice logs into a table by day
(``log_days``): a day's rows are those of the last run that had the day.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession

# The sample rows of the log table.
SAMPLE_ROWS = [
    (date(2022, 11, 8), "ETL_WH", 433),
    (date(2022, 11, 8), "ML_LOAD_WH", 1398),
    (date(2022, 11, 8), "ADHOC_WH", 466),
    (date(2022, 11, 8), "USER_WH", 245),
    (date(2022, 11, 8), "ANALYTICS_WH", 683),
]


def create_log_table(spark: SparkSession, name: str | None = None, by_day: bool = False) -> str:
    """Create an empty log table, managed by the catalog, and return its full name.

    With ``by_day`` each day is a partition; Spark then has the day as last column.
    """
    name = name or f"spark_catalog.default.wh_logs_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (start_date DATE, warehouse_name VARCHAR(10000),"
        " credits_used_date_wh DECIMAL(38,0))"
        f" USING parquet {'PARTITIONED BY (start_date)' if by_day else ''}"
    )
    return name


@contextmanager
def passing_log_table(spark: SparkSession, by_day: bool = False) -> Iterator[str]:
    """A log table that is dropped, with its files, at the end of the block."""
    name = create_log_table(spark, by_day=by_day)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def replace_partitions(name: str, rows: DataFrame) -> None:
    """Write ``rows``, matched by name, in place of the partitions they have; others stay.

    The partitions are replaced when the job commits, so a run that fails changes nothing. Spark takes the
    mode of an insert from the session only, so it is set for the time of the write.
    """
    spark = rows.sparkSession
    matched, mode = rows.select(*spark.table(name).columns), spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        matched.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)


def log_days(name: str, rows: DataFrame) -> None:
    """Log ``rows``, matched by name, in place of what a table by day holds of the days they have.

    Other days stay, and a run that is repeated leaves the rows of one run.
    """
    replace_partitions(name, rows)


def append_query(name: str, rows: DataFrame) -> None:
    """Append ``rows``, matched by position as ``INSERT INTO .. SELECT *`` does."""
    rows.write.insertInto(name)


def append_values(spark: SparkSession, name: str, rows: Iterable[tuple[date, str, int]]) -> None:
    """Append literal rows. Each is cast: Spark refuses to store a plain string as a DATE.

    Columns are named, since a table by day has them in another order.
    """
    # Named markers: Spark 4.1 binds positional ones out of order in a list of VALUES.
    args, values = {}, []
    for i, (day, pool, credits) in enumerate(rows):
        args |= {f"d{i}": day, f"p{i}": pool, f"c{i}": credits}
        values.append(f"(CAST(:d{i} AS DATE), CAST(:p{i} AS STRING), CAST(:c{i} AS DECIMAL(38,0)))")
    columns = "start_date, warehouse_name, credits_used_date_wh"
    spark.sql(f"INSERT INTO {name} ({columns}) VALUES {', '.join(values)}", args=args)
