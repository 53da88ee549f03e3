"""The usage reports. ``as_of`` stands for the current time, so a report can be repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.dates import moment, month_before
from creditloom.functions.text import float_text, html_row
from creditloom.operators.aggregates import pivot_mean
from creditloom.operators.joins import PART_ROWS, join_hot_keys


def daily_credits(metering: DataFrame, as_of: datetime) -> DataFrame:
    """Credits by day and pool, days without credits left out, whole numbers.

    "day > moment" holds for the days after the moment's own day; as a comparison of dates it
    reaches the scan as a bound on ``start_time``.
    """
    since = F.to_date(month_before(as_of, metering, "start_time"))
    day = F.to_date("start_time")
    return (
        metering.filter(day > since)
        .groupBy(day.alias("start_date"), "warehouse_name")
        .agg(F.sum("credits_used").alias("total"))
        .filter("total > 0")
        .select(
            "start_date",
            "warehouse_name",
            F.round("total").cast("decimal(38,0)").alias("credits_used_date_wh"),
        )
    )


def user_credits(usage: DataFrame, metering: DataFrame, as_of: datetime) -> DataFrame:
    """Each pool's hourly credits, shared out by the time its users ran queries in that hour."""
    return user_shares(usage, metering, as_of).orderBy(
        F.desc("approximate_credits_used"), "user_name", "warehouse_name"
    )


def share_of(part: Column, whole: Column, amount: Column) -> Column:
    """``part / whole * amount`` as a decimal of 12 places.

    Sums of it do not depend on the order of the rows, as sums of doubles do.
    """
    counts = "decimal(16,0)"
    return part.cast(counts) * amount.cast("decimal(18,9)") / whole.cast(counts)


def cents(total: Column) -> Column:
    """A sum of shares in cents. Nine places first: what makes three thirds is a whole again."""
    return F.round(F.round(total, 9), 2).cast("decimal(18,2)")


POOL_HOUR = ["warehouse_name", "start_hour"]


def user_hours(usage: DataFrame) -> DataFrame:
    """``(user_name, warehouse_name, start_hour, user_time)``: the time that counts, by hour."""
    hour = F.date_trunc("hour", "start_time").alias("start_hour")
    return (
        usage.filter(F.col("warehouse_name").isNotNull() & (F.col("execution_time") > 0))
        .groupBy("user_name", "warehouse_name", hour)
        .agg(F.sum("execution_time").alias("user_time"))
        .filter(F.col("start_hour").isNotNull())
    )


def user_shares(
    usage: DataFrame, metering: DataFrame, as_of: datetime, part_rows: int = PART_ROWS
) -> DataFrame:
    """``user_credits`` without its order.

    The first aggregate shrinks the history to (user, pool, hour) before anything else moves; see
    ``shares_of_hours`` for the rest.
    """
    since = month_before(as_of, usage, "start_time")
    user_hour = user_hours(usage.filter(F.col("start_time") > since))
    return shares_of_hours(user_hour, metering, as_of, part_rows)


def shares_of_hours(
    user_hour: DataFrame, metering: DataFrame, as_of: datetime, part_rows: int = PART_ROWS
) -> DataFrame:
    """``user_credits`` without its order, from ``user_hours`` of the period.

    The hour totals meet the credits first, both with one row per pool and hour, and then the user rows,
    where a busy hour with very many of them is cut by user. The totals carry the number of users, so the
    busy hours need no count of their own.
    """
    # No query of the period starts in an earlier hour; this bound also spares reading old credits.
    first_hour = F.date_trunc("hour", month_before(as_of, metering, "start_time"))
    credits = metering.filter(F.col("start_time") >= first_hour).select(
        "warehouse_name", F.col("start_time").alias("start_hour"), "credits_used"
    )
    totals = user_hour.groupBy(*POOL_HOUR).agg(
        F.sum("user_time").alias("hour_time"), F.count("*").alias("key_rows")
    )
    hours = totals.join(credits, POOL_HOUR).drop("key_rows")
    used = share_of(F.col("user_time"), F.col("hour_time"), F.col("credits_used"))
    return (
        join_hot_keys(user_hour, hours, POOL_HOUR, ["user_name"], part_rows, totals)
        .groupBy("user_name", "warehouse_name")
        .agg(cents(F.sum(used)).alias("approximate_credits_used"))
    )


def query_shapes(
    usage: DataFrame, as_of: datetime, at_least: int = 10, top: int = 20
) -> DataFrame:
    """The most frequent beginnings of query texts; ties go to the lesser text."""
    since = F.add_months(F.to_date(moment(as_of, usage, "start_time")), -1)
    return (
        usage.filter((F.to_date("start_time") > since) & (F.col("total_elapsed_time") > 0))
        .groupBy(F.col("query_text").substr(0, 25).alias("partial_query_text"))
        .agg(
            F.count("*").alias("number_of_queries"),
            (F.sum("total_elapsed_time") / (1000 * 60)).alias("execution_minutes"),
        )
        .filter(F.col("number_of_queries") >= at_least)
        .orderBy(F.desc("number_of_queries"), "partial_query_text")
        .limit(top)
    )


def credit_matrix(log: DataFrame, days: list | None = None) -> DataFrame:
    """Pools down, days across, the mean of the logged credits in each cell."""
    return pivot_mean(log, "warehouse_name", "start_date", "credits_used_date_wh", days)


def user_credit_html(user_credits: DataFrame, escaped: bool = False) -> Column:
    cells = ["user_name", "warehouse_name"]
    return html_row(
        *[user_credits[c] for c in cells],
        float_text(user_credits["approximate_credits_used"].cast("double"), 2),
        escaped=escaped,
    )


def query_shape_html(shapes: DataFrame, escaped: bool = False) -> Column:
    return html_row(
        shapes["partial_query_text"],
        shapes["number_of_queries"],
        float_text(shapes["execution_minutes"], 6),
        escaped=escaped,
    )


def daily_credit_html(daily: DataFrame, escaped: bool = False) -> Column:
    return html_row(
        daily["start_date"], daily["warehouse_name"], daily["credits_used_date_wh"], escaped=escaped
    )


def shape_fragment(shapes: DataFrame) -> DataFrame:
    """The rows of ``query_shapes`` as one string; its limit bounds the list."""
    row = F.struct(
        (-F.col("number_of_queries")).alias("rank"),
        "partial_query_text",
        query_shape_html(shapes).alias("html"),
    )
    rows = F.array_sort(F.collect_list(row))
    return shapes.agg(F.array_join(F.transform(rows, lambda r: r["html"]), "").alias("fragment"))


REPORT_HEAD = [
    "<!DOCTYPE html>", "<html>", "<head>", "<meta charset='utf-8'>",
    "<style>td, th { padding: 0.3em; border-bottom: thin solid gray; }</style>",
    "</head>", "<body>",
]
# The headings and column titles of the two tables.
USER_HEAD = [
    "<hr>", "<br>", "<h3>Approx. Users Credit Consumption Report</h3>", "<br>", "<table>",
    "<tr><th>USER NAME</th><th>WAREHOUSE NAME</th><th>APPROX. CREDITS USED</th></tr>",
]
SHAPE_HEAD = [
    "</table>", "<br>", "<h3>Queries by # Executed and their Execution Time</h3>", "<br>",
    "<table>",
    "<tr><th>PARTIAL QUERY TEXT</th><th>NUMBER OF QUERIES</th><th>EXECUTION TIME IN MINS</th></tr>",
]
REPORT_END = ["</body>", "</html>"]


def report_lines(
    user_credits: DataFrame,
    shapes: DataFrame,
    title: str = "Utilization Report",
    image: str = "img.jpg",
) -> DataFrame:
    """The HTML report, ``(section, place, line)``, one row per line, in order.

    The user table has no bound, so the report stays a distributed frame; ``write_report`` saves it.
    """
    spark = user_credits.sparkSession
    heading = f"<h2>{title}</h2>"
    image_part = ["</table>", "<br>", f"<h3>{title}</h3>"]
    image_part.append(f"<img height=auto width=100% src='cid:{image}'></img>")
    fixed = {
        0: [*REPORT_HEAD, heading, *USER_HEAD],
        2: SHAPE_HEAD,
        4: [*image_part, *REPORT_END],
    }
    rows = [
        (section, float(i), "", "", line)
        for section, lines in fixed.items()
        for i, line in enumerate(lines)
    ]
    names = "section int, place double, tie1 string, tie2 string, line string"
    users = user_credits.select(
        F.lit(1).alias("section"),
        (F.lit(0) - F.col("approximate_credits_used").cast("double")).alias("place"),
        F.col("user_name").alias("tie1"),
        F.col("warehouse_name").alias("tie2"),
        user_credit_html(user_credits).alias("line"),
    )
    queries = shapes.select(
        F.lit(3).alias("section"),
        (F.lit(0) - F.col("number_of_queries")).cast("double").alias("place"),
        F.col("partial_query_text").alias("tie1"),
        F.lit("").alias("tie2"),
        query_shape_html(shapes).alias("line"),
    )
    lines = spark.createDataFrame(rows, names).unionAll(users).unionAll(queries)
    return lines.orderBy("section", "place", "tie1", "tie2").select("section", "place", "line")


def write_report(lines: DataFrame, folder: str) -> None:
    """Save the report as text; its part files in name order are the document."""
    lines.select("line").write.text(folder)
