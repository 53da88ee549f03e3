"""Lower bounds for the look-back filters, as constants of the filtered column's own type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of: datetime, like: DataFrame, column: str) -> Column:
    """``as_of`` in the type of ``like[column]``.

    A literal of another type makes Spark cast the column, and a cast column is not pushed down.
    The text form keeps the driver machine's time zone out of it.
    """
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").cast(like.schema[column].dataType)


def month_before(as_of: datetime, like: DataFrame, column: str) -> Column:
    """One calendar month before ``as_of``, clamped to the end of a shorter month."""
    return F.timestamp_add("MONTH", F.lit(-1), moment(as_of, like, column))
