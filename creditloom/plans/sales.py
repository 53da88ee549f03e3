"""Queries over the sales table: pick, filter, join, sort, aggregate, number, fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.aggregates import by_name, exact_stddev
from creditloom.operators.numbering import global_row_number, numbered_as_sorted
from creditloom.operators.ordering import directed, sort_spread

ORDER_COLUMNS = ["cs_order_number", "cs_quantity", "cs_wholesale_cost", "cs_list_price"]


def sold_times(sales: DataFrame) -> DataFrame:
    return sales.select(F.col("cs_sold_time_sk"))


def renamed(sales: DataFrame) -> DataFrame:
    return sales.select(F.col("cs_sold_time_sk").alias("column1"), F.col("cs_bill_cdemo_sk"))


def time_prefix(sales: DataFrame) -> DataFrame:
    """The first three digits of a numeric key; Spark reads start 0 as start 1."""
    return sales.select(F.col("cs_sold_time_sk").substr(0, 3).alias("column1"))


def cost_at(sales: DataFrame, time_sk: int, cdemo_sk: int) -> DataFrame:
    both = (F.col("cs_sold_time_sk") == time_sk) & (F.col("cs_bill_cdemo_sk") == cdemo_sk)
    return sales.filter(both).select("cs_ext_wholesale_cost")


def cost_at_either(sales: DataFrame, time_sk: int, cdemo_sk: int) -> DataFrame:
    either = (F.col("cs_sold_time_sk") == time_sk) | (F.col("cs_bill_cdemo_sk") == cdemo_sk)
    return sales.filter(either).select(
        "cs_order_number", "cs_line_number", "cs_ext_wholesale_cost"
    )


def joined_logs(sales: DataFrame, logs: DataFrame) -> DataFrame:
    """Every sale with every log entry of its item.

    No hint: Spark broadcasts the logs while their measured size allows it, and beyond that its
    skew join splits an item that holds many sales.
    """
    return sales.join(logs, sales["cs_item_sk"] == logs["cs_item_sk"], "inner").select(
        sales["cs_item_sk"], "cs_order_number", "cs_line_number", "cs_list_price", "log_tag"
    )


def _priced(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("cs_quantity").isNotNull() & F.col("cs_wholesale_cost").isNotNull())


# Rows equal in these and in the sort keys look the same in the results.
TIES = ("cs_order_number", "cs_list_price")


def by_quantity_then_cost(sales: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Quantity up, cost down; the sort keys need not be among the result columns."""
    order = [F.col("cs_quantity").asc(), F.col("cs_wholesale_cost").desc(), *map(F.col, ties)]
    return sort_spread(_priced(sales), *order, from_scan=True).select(*ORDER_COLUMNS)


def by_quantity_and_cost(sales: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Both up: where a list of flags is given, it decides the directions."""
    order = [*directed({"cs_quantity": 1, "cs_wholesale_cost": 1}), *map(F.col, ties)]
    return sort_spread(_priced(sales), *order, from_scan=True).select(*ORDER_COLUMNS)


def with_place(ordered: DataFrame) -> DataFrame:
    """A sorted frame with the place of each row in it."""
    return numbered_as_sorted(ordered, "place")


def quantity_totals(sales: DataFrame) -> DataFrame:
    quantity = F.col("cs_quantity")
    return sales.agg(
        F.sum(quantity).alias("qty_sum"),
        exact_stddev(sales, "cs_quantity").alias("qty_stddev"),
        F.count(quantity).alias("qty_count"),
    )


def extremes(sales: DataFrame) -> DataFrame:
    return sales.agg(*by_name(("cs_quantity", "min"), ("cs_wholesale_cost", "max")))


def extremes_by_dict(sales: DataFrame) -> DataFrame:
    names = {
        "min(cs_quantity)": "min_cs_quantity",
        "max(cs_wholesale_cost)": "max_cs_wholesale_cost",
    }
    return (
        sales.agg({"cs_quantity": "min", "cs_wholesale_cost": "max"})
        .withColumnsRenamed(names)
        .select(*names.values())
    )


def by_date(sales: DataFrame) -> DataFrame:
    return sales.groupBy("cs_sold_date_sk").agg(
        F.sum("cs_quantity").alias("qty_sum"),
        exact_stddev(sales, "cs_wholesale_cost").alias("std_dev"),
    )


def numbered(sales: DataFrame) -> DataFrame:
    """Row numbers from the latest date to the earliest.

    Null dates come first. Within a date the order is by order, line and the result's own columns,
    so only rows that look the same can change places.
    """
    order = [
        F.col("cs_sold_date_sk").desc_nulls_first(),
        F.col("cs_order_number").asc(),
        F.col("cs_line_number").asc(),
        F.col("cs_quantity").asc(),
        F.col("cs_wholesale_cost").asc(),
        F.col("cs_list_price").asc(),
    ]
    needed = sales.select("cs_sold_date_sk", "cs_line_number", *ORDER_COLUMNS)
    found = global_row_number(needed, order, "rank", from_scan=True)
    return found.select("rank", *ORDER_COLUMNS)


def filled(sales: DataFrame, quantity: int = 111) -> DataFrame:
    """Sales without quantity and cost, with a stand-in quantity; the cost stays null."""
    neither = F.col("cs_quantity").isNull() & F.col("cs_wholesale_cost").isNull()
    return sales.filter(neither).select(*ORDER_COLUMNS).na.fill({"cs_quantity": quantity})
