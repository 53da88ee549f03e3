"""Aggregates named by (column, function), exact standard deviations, and the mean pivot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def exact_stddev(df: DataFrame, name: str) -> Column:
    """The sample standard deviation of a whole-number or decimal column, null below two values.

    An aggregate of doubles ends in other digits when rows come in another order. Here values count in
    their smallest unit, so their sum and the sum of their squares are whole numbers, the same for any
    order and any partitions; one division and one root follow. Like those of Spark's own aggregate the
    sums are partial before a shuffle. The squares have to sum to less than 10**38 units, or the sum fails.
    """
    kind = df.schema[name].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    digits = kind.precision if isinstance(kind, DecimalType) else 19
    unit = F.col(name) * F.lit(10**scale).cast(f"decimal({scale + 1},0)") if scale else F.col(name)
    whole = unit.cast(f"decimal({min(digits, 19)},0)")
    n, total, squares = F.count(name), F.sum(whole), F.sum(whole * whole)
    # n * squares - total * total has no rounding while it fits into 38 digits, as it does for 10**12
    # prices; beyond that the three sums are exact and only this step is rounded, always in the same way.
    exact = F.try_subtract(
        F.try_multiply(n.cast("decimal(19,0)"), squares), F.try_multiply(total, total)
    ).cast("double")
    rounded = n.cast("double") * squares.cast("double") - total.cast("double") * total.cast("double")
    pairs = n.cast("double") * (n - 1).cast("double")
    spread = F.greatest(F.coalesce(exact, rounded), F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / pairs) / F.lit(float(10**scale)))


def by_name(*pairs: tuple[str, str] | Mapping[str, str]) -> list[Column]:
    """Aggregates for ``("a", "min"), ("b", "max")`` or ``{"a": "min", "b": "max"}``.

    ``DataFrame.agg`` takes the dict but not the pairs, and a dict names each column once only.
    The results are called ``min_a``, ``max_b``.
    """
    named = []
    for pair in pairs:
        named += pair.items() if isinstance(pair, Mapping) else [pair]
    return [getattr(F, fn)(column).alias(f"{fn}_{column}") for column, fn in named]


def pivot_mean(
    df: DataFrame, index: str, columns: str, value: str, column_values: list | None = None
) -> DataFrame:
    """One row per ``index``, one column per ``columns`` value, the mean of ``value`` in each cell.

    Rows without an index, a column or a value are left out, so no row or column is all null.
    Without ``column_values`` Spark runs a distinct job for them first, and refuses more than
    ``spark.sql.pivotMaxValues``; give them when ``df`` is costly to compute.
    """
    kept = df.dropna(subset=[index, columns, value])
    mean = F.avg(F.col(value).cast("double"))
    return kept.groupBy(index).pivot(columns, column_values).agg(mean)
