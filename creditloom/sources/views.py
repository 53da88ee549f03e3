"""The sales and usage tables, as projections over the TPC-H-like test tables.

They are plain projections (``metering`` adds one aggregate), so column pruning and the filters on
base columns still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The tables the views are made of. With the columns declared, plans need no look into the files.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "pages": "page_id bigint, url string, html string",
}


# Tables whose columns have been compared, by application and path.
_compared: set[tuple[str, str]] = set()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with its declared columns. One that lost or renamed any of them is refused."""
    path = f"{folder}/{name}.parquet"
    table = spark.read.schema(TABLES[name]).parquet(path)
    require_columns(spark, path, table.columns)
    return table


def require_columns(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Raise ValueError if the files at ``path`` have no column of one of these names.

    Spark reads a declared column that the files do not have as nulls. The footer that Spark takes the
    schema from is read once per table and application. Names count as Spark's case setting says.
    """
    key = (spark.sparkContext.applicationId, path)
    if key in _compared:
        return
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if exact else str.lower
    found = spark.read.parquet(path).columns
    known = {fold(column) for column in found}
    lost = [column for column in columns if fold(column) not in known]
    if lost:
        raise ValueError(f"{path} has no column {', '.join(lost)}; it has {', '.join(found)}")
    _compared.add(key)


def sales(spark: SparkSession, folder: str) -> DataFrame:
    # The price is a column of its own first: Spark then converts it once, not once per use.
    lines = read_table(spark, folder, "lineitem").withColumn(
        "price", F.col("l_extendedprice").cast("decimal(12,2)")
    )
    line = F.col("l_linenumber")
    return lines.select(
        F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).alias(
            "cs_sold_date_sk"
        ),
        (F.col("l_orderkey") % 86400).alias("cs_sold_time_sk"),
        F.col("l_suppkey").alias("cs_bill_cdemo_sk"),
        F.col("l_partkey").alias("cs_item_sk"),
        F.col("l_orderkey").alias("cs_order_number"),
        line.alias("cs_line_number"),
        F.when(line == 7, None).otherwise(F.col("l_quantity").cast("int")).alias("cs_quantity"),
        F.when(line >= 6, None).otherwise(F.col("price")).alias("cs_wholesale_cost"),
        F.col("price").alias("cs_list_price"),
        (F.col("price") * F.col("l_quantity").cast("decimal(4,0)")).alias("cs_ext_wholesale_cost"),
    )


def sales_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Log entries of items: one for a larger item, one for an economy item, so also none or two."""
    part = read_table(spark, folder, "part")
    item = F.col("p_partkey").alias("cs_item_sk")
    by_brand = part.filter(F.col("p_size") > 15).select(item, F.col("p_brand").alias("log_tag"))
    by_type = part.filter(F.col("p_type") == "ECONOMY").select(
        item, F.concat(F.col("p_type"), F.lit(" "), F.col("p_name")).alias("log_tag")
    )
    return by_brand.unionAll(by_type)


def usage_history(spark: SparkSession, folder: str) -> DataFrame:
    def measure(factor: int, idle: int):
        spent = F.round(F.col("value") * factor).cast("bigint")
        return F.when(F.col("event_id") % idle == 0, 0).otherwise(spent)

    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    return read_table(spark, folder, "events").select(
        F.concat(F.lit("user_"), user).alias("user_name"),
        F.when(kind == "error", None)
        .otherwise(F.concat(F.upper(kind), F.lit("_WH")))
        .alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        measure(100, 17).alias("execution_time"),
        measure(120, 13).alias("total_elapsed_time"),
        F.concat(F.lit("select u"), user, F.lit(" from "), kind, F.lit(" limit 100")).alias(
            "query_text"
        ),
    )


def metering(spark: SparkSession, folder: str) -> DataFrame:
    """Credits by pool and hour; every seventh day of the month costs nothing."""
    hourly = (
        read_table(spark, folder, "events")
        .filter(F.col("event_type") != "signup")
        .groupBy(
            F.concat(F.upper("event_type"), F.lit("_WH")).alias("warehouse_name"),
            F.date_trunc("hour", "ts").alias("start_time"),
        )
        .agg(F.count("*").alias("n"))
    )
    credits = F.when(F.dayofmonth("start_time") % 7 == 0, 0).otherwise(F.col("n") * F.lit(0.25))
    return hourly.select(
        "warehouse_name", "start_time", credits.cast("decimal(18,9)").alias("credits_used")
    )
