"""A sort that also spreads rows whose sort keys are equal."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.sources.shared import checkpointed

POSITION = "_position"


def spread_ties(
    df: DataFrame, order: list[Column], from_scan: bool
) -> tuple[DataFrame, list[Column]]:
    """``df`` with each row's position, and sort keys that end in it."""
    fixed = df if from_scan else checkpointed(df)
    return fixed.withColumn(POSITION, F.monotonically_increasing_id()), [*order, F.col(POSITION)]


def sort_spread(df: DataFrame, *order: Column, from_scan: bool = False) -> DataFrame:
    """``df.orderBy(*order)``, ties in the order of ``df``.

    A range partitioned sort keeps equal keys in one task. With the position as the last key the
    range bounds can also fall within a run of ties, however long. Positions have to be the same
    when a task is run again, or rows would be lost and doubled. They are in a plain scan of
    tables, which ``from_scan`` states; any other frame, say of a join, is checkpointed first.
    """
    tied, keys = spread_ties(df, list(order), from_scan)
    return tied.orderBy(*keys).drop(POSITION)


def directed(flags: Mapping[str, int | bool]) -> list[Column]:
    """Sort columns with a direction each, 1 for ascending.

    The names are bare: next to a column that already has ``.desc()``, PySpark's own ``ascending``
    list leaves that direction as it is, where here the flag is to decide.
    """
    return [F.col(name).asc() if up else F.col(name).desc() for name, up in flags.items()]
