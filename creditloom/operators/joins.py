"""An inner join of rows with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task joins; a key with more is cut into parts of about so many.
PART_ROWS = 1_000_000


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, key_rows)``: how many rows each key has; a task sends one row a key."""
    return rows.groupBy(*keys).agg(F.count("*").alias("key_rows"))


def join_hot_keys(
    rows: DataFrame,
    side: DataFrame,
    keys: list[str],
    salt_by: list[str],
    part_rows: int = PART_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``keys``, where one key may hold a large part of ``rows``.

    Keys are counted first. One with more than ``part_rows`` rows is hot: its rows are cut into parts by a
    hash of ``salt_by``, as many as its count asks for, and its row of the side is repeated for each. All
    other keys stay as they are. At most one in ``part_rows`` rows can be of a new hot key, which bounds
    the table of hot keys that is broadcast. There is no other hint: once the side's shuffle has a size,
    Spark may broadcast it and leave the rows where they are. ``part_rows`` changes the plan only, never
    the result. ``counts``, as of ``key_counts``, spares counting where it has been done.
    """
    salt, parts = "_salt", "_parts"
    counted = key_counts(rows, keys) if counts is None else counts
    named = {key: f"_hot_{key}" for key in keys}
    hot = counted.where(F.col("key_rows") > part_rows).select(
        *[F.col(key).alias(name) for key, name in named.items()],
        F.ceil(F.col("key_rows") / part_rows).cast("int").alias(parts),
    )

    def with_parts(frame: DataFrame) -> DataFrame:
        condition = F.lit(True)
        for key, name in named.items():
            condition = condition & (frame[key] == hot[name])
        return frame.join(F.broadcast(hot), condition, "left").drop(*named.values())

    part = F.pmod(F.xxhash64(*salt_by), F.col(parts)).cast("int")
    salted = with_parts(rows).withColumn(salt, F.coalesce(part, F.lit(0))).drop(parts)
    last = F.coalesce(F.col(parts), F.lit(1)) - 1
    repeated = with_parts(side).withColumn(salt, F.explode(F.sequence(F.lit(0), last))).drop(parts)
    return salted.join(repeated, [*keys, salt]).drop(salt)
