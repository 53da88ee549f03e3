"""Row numbers over a whole table, without sending it through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.ordering import spread_ties
from creditloom.sources.shared import checkpointed

# monotonically_increasing_id() keeps the row's place within its partition in the low 33 bits.
PLACE_BITS = (1 << 33) - 1


def global_row_number(
    df: DataFrame, order: list[Column], name: str, from_scan: bool = False
) -> DataFrame:
    """``row_number() over (order by ..)`` with no partition clause.

    Spark plans that window as a single task. Here the rows are range partitioned and sorted, each
    keeps its place within its partition, and the places are shifted by the rows that come before
    the partition. Ties are spread as in ``ordering.sort_spread``, which also says what
    ``from_scan`` means.
    """
    tied, keys = spread_ties(df, order, from_scan)
    ordered = tied.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return numbered_as_sorted(ordered, name).select(*df.columns, name)


def numbered_as_sorted(ordered: DataFrame, name: str) -> DataFrame:
    """A sorted frame with the place of each row, from 1, in column ``name``.

    The frame is checkpointed: range bounds come from a sample and a second run might cut elsewhere.
    Spark deletes the copy when the result is out of use.
    """
    part, place = f"_{name}_part", f"_{name}_place"
    placed = checkpointed(
        ordered.select(
            *ordered.columns,
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)).alias(place),
        )
    )
    # One row per sorted partition, at most spark.sql.shuffle.partitions of them: this bounds both
    # the single-task window and the broadcast.
    sizes = placed.groupBy(part).agg(F.count("*").alias("size"))
    earlier = F.sum("size").over(Window.orderBy(part)) - F.col("size")
    offsets = sizes.select(part, earlier.alias("earlier"))
    number = (F.col("earlier") + F.col(place) + 1).alias(name)
    return placed.join(F.broadcast(offsets), part).select(*ordered.columns, number)
