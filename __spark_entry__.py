
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from creditloom.functions.versions import register_versions  # noqa: E402
from creditloom.operators import page_nodes as P  # noqa: E402
from creditloom.operators.concurrent import run_all  # noqa: E402
from creditloom.plans import report_sql, reports  # noqa: E402
from creditloom.plans import sales as S  # noqa: E402
from creditloom.sources import csv_text, log_table, rollup, views  # noqa: E402
from creditloom.sources.shared import checkpointed  # noqa: E402

# The operators for training data are a part that can be taken away.
LLM_MODULES = {"corpus_pipeline", "creditloom.llm", "creditloom.llm.queries"}
try:
    import corpus_pipeline  # noqa: E402

    from creditloom.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in LLM_MODULES:
        raise
    llm = None
except ImportError as missing:
    if missing.name != "creditloom.llm":
        raise
    llm = None

# The "current time" of the reports.
CREDITS_AS_OF = datetime(2024, 2, 10)
SHAPES_AS_OF = datetime(2024, 2, 1)


def entry(spark: SparkSession) -> DataFrame:
    return queries()["user_credits"](spark, "/root/testdata/sf0.001")


# --- usage reports --------------------------------------------------------------------------------


def user_credits(spark, sf):
    return reports.user_credits(
        views.usage_history(spark, sf), views.metering(spark, sf), CREDITS_AS_OF
    )


def user_credits_sql(spark, sf):
    """With the place of each row, which shows the order of the report."""
    tables = {"usage": views.usage_history(spark, sf), "metering": views.metering(spark, sf)}
    report = report_sql.run_report(spark, report_sql.USER_CREDITS, CREDITS_AS_OF, tables)
    return S.with_place(report)


def user_credits_rollup(spark, sf):
    """The report from an hourly rollup, whose last days are refreshed a second time."""
    usage, metering = views.usage_history(spark, sf), views.metering(spark, sf)
    first, last = CREDITS_AS_OF.date() - timedelta(days=31), CREDITS_AS_OF.date()
    # The test history goes on after the day of the report, and the report takes all of it.
    end = usage.agg(F.to_date(F.max("start_time"))).first()[0] or last
    with rollup.passing_rollup(spark) as name:
        rollup.refresh(name, usage, first, end)
        rollup.refresh(name, usage, last, end)
        hours = rollup.hours_since(spark.table(name), CREDITS_AS_OF)
        return checkpointed(reports.shares_of_hours(hours, metering, CREDITS_AS_OF))


def daily_credits(spark, sf):
    return reports.daily_credits(views.metering(spark, sf), CREDITS_AS_OF)


def daily_credits_sql(spark, sf):
    tables = {"metering": views.metering(spark, sf)}
    return report_sql.run_report(spark, report_sql.DAILY_CREDITS, CREDITS_AS_OF, tables)


def query_shapes(spark, sf):
    return reports.query_shapes(views.usage_history(spark, sf), SHAPES_AS_OF)


def query_shapes_sql(spark, sf):
    tables = {"usage": views.usage_history(spark, sf)}
    return report_sql.run_report(
        spark, report_sql.QUERY_SHAPES, SHAPES_AS_OF, tables, at_least=10, top=20
    )


def credit_matrix(spark, sf):
    """Logs the daily credits, then once more at three times the amount, and pivots the log."""
    with log_table.passing_log_table(spark) as name:
        log_table.append_query(name, daily_credits(spark, sf))
        again = (F.col("credits_used_date_wh") * 3).cast("decimal(38,0)")
        log_table.append_query(name, spark.table(name).withColumn("credits_used_date_wh", again))
        first_day = CREDITS_AS_OF.date() - timedelta(days=31)
        days = [first_day + timedelta(days=i + 1) for i in range(31)]
        found = reports.credit_matrix(spark.table(name), days)
        return checkpointed(found)


def log_table_append(spark, sf):
    with log_table.passing_log_table(spark) as name:
        log_table.append_query(name, daily_credits(spark, sf))
        log_table.append_values(spark, name, log_table.SAMPLE_ROWS)
        return checkpointed(spark.table(name))


def log_table_rerun(spark, sf):
    """The report of a run that went wrong, logged again: what the second run says stays, once."""
    with log_table.passing_log_table(spark, by_day=True) as name:
        log_table.append_values(spark, name, log_table.SAMPLE_ROWS)
        daily = daily_credits(spark, sf)
        wrong = (F.col("credits_used_date_wh") * 3).cast("decimal(38,0)")
        log_table.log_days(name, daily.withColumn("credits_used_date_wh", wrong))
        for _ in range(2):
            log_table.log_days(name, daily)
        return checkpointed(spark.table(name))


def credit_html_rows(spark, sf):
    daily = daily_credits(spark, sf)
    return daily.select(reports.daily_credit_html(daily).alias("html"))


def user_html_rows(spark, sf):
    shares = user_credits(spark, sf)
    html = reports.user_credit_html(shares).alias("html")
    return shares.select("user_name", "warehouse_name", html)


def report_fragment(spark, sf):
    return reports.shape_fragment(query_shapes(spark, sf))


def report_page(spark, sf):
    shares = reports.user_shares(
        views.usage_history(spark, sf), views.metering(spark, sf), CREDITS_AS_OF
    )
    return reports.report_lines(shares, query_shapes(spark, sf))


# --- sales ----------------------------------------------------------------------------------------


def on_sales(plan: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf: plan(views.sales(spark, sf))


def sales_join_logs(spark, sf):
    return S.joined_logs(views.sales(spark, sf), views.sales_logs(spark, sf))


def sales_limit_count(spark, sf):
    """Which rows a limit without an order returns is open, so they are counted."""
    some = spark.sql("SELECT * FROM {sales} LIMIT 20", sales=views.sales(spark, sf))
    return some.agg(F.count("*").alias("n"))


def sales_by_week(spark, sf):
    """Sales per week, the weeks being a sequence over the dates sold."""
    sales = views.sales(spark, sf)
    day = F.col("cs_sold_date_sk")
    first, last = sales.agg(F.min(day), F.max(day)).first()
    # Without dates there are no weeks.
    first, end = (0, 0) if first is None else (first, last + 1)
    weeks = spark.range(first, end, 7).toDF("week_start")
    start = F.lit(first) + F.floor((day - first) / 7) * 7
    sold = sales.groupBy(start.alias("week")).agg(
        F.count("*").alias("n"), F.sum("cs_quantity").alias("qty_sum")
    )
    return weeks.join(sold, weeks["week_start"] == sold["week"]).drop("week")


def local_rows(spark, sf):
    """Sales per line number, named by a small frame of local rows."""
    words = "one two three four five six seven".split()
    names = spark.createDataFrame(list(enumerate(words, start=1)), schema=["col_1", "col_2"])
    lines = views.sales(spark, sf).groupBy("cs_line_number").agg(F.count("*").alias("n"))
    named = lines.join(names, lines["cs_line_number"] == names["col_1"])
    return named.select("col_1", "col_2", "n")


def csv_lines(spark, sf):
    """Parts as CSV text, some rows short, long or with empty fields."""
    kind = F.col("p_partkey") % 4
    name, url, user, size = (F.col(c) for c in ("p_name", "p_brand", "p_type", "p_size"))
    null = F.lit(None).cast("string")
    line = (
        F.when(kind == 1, csv_text.csv_line(name, url))
        .when(kind == 2, csv_text.csv_line(name, url, user, size, F.lit("more"), F.lit("fields")))
        .when(kind == 3, csv_text.csv_line(name, null, user, null))
        .otherwise(csv_text.csv_line(name, url, user, size))
    )
    return views.read_table(spark, sf, "part").select(line.alias("value"))


CSV_FIELDS = T.StructType(
    [T.StructField(field, T.StringType()) for field in ("name", "url", "username", "password")]
)


def csv_scan(spark, sf):
    with csv_text.passing_text(csv_lines(spark, sf)) as folder:
        return checkpointed(csv_text.read_csv(spark, folder, CSV_FIELDS))


def csv_malformed(spark, sf):
    """How many records have the declared number of fields, and how many another."""
    with csv_text.passing_text(csv_lines(spark, sf)) as folder:
        rows = csv_text.read_csv(spark, folder, CSV_FIELDS, corrupt="bad")
        state = F.when(F.col("bad").isNull(), "whole").otherwise("malformed")
        return checkpointed(rows.groupBy(state.alias("state")).agg(F.count("*").alias("n")))


# --- pages ----------------------------------------------------------------------------------------


def parsed(spark, sf, tags=None, with_text=True):
    pages = views.read_table(spark, sf, "pages")
    return P.parse_pages(pages, tags=tags, with_text=with_text, spread=True)


def page_elements_by_tag_attr(spark, sf):
    ad = P.where(tag="div", attrs={"class": "ad"})
    return parsed(spark, sf, ["div"]).select(
        "page_id",
        F.size(P.all_nodes("nodes", ad)).alias("ads"),
        P.node_text(P.first_node("nodes", ad)).alias("first_ad"),
    )


def page_attr(spark, sf):
    return parsed(spark, sf, with_text=False).select(
        "page_id",
        P.first_node("nodes", P.where(tag="html"))["attrs"]["lang"].alias("lang"),
        P.first_node("nodes", P.where(attrs={"class": "ad"}))["tag"].alias("ad_tag"),
        P.first_node("nodes", P.where(tag="a"))["attrs"]["href"].alias("first_href"),
    )


def page_first_tag_text(spark, sf):
    title = P.node_text(P.first_node("nodes", P.where(tag="title")))
    return parsed(spark, sf, ["title"]).select("page_id", title.alias("title"))


def page_exact_text(spark, sf):
    named = P.where(string="The")
    return parsed(spark, sf, [P.TEXT]).select(
        "page_id",
        P.node_text(P.first_node("nodes", named)).alias("first_match"),
        F.size(P.all_nodes("nodes", named)).alias("matches"),
    )


def page_text_contains(spark, sf):
    items = P.all_nodes("nodes", P.where(tag="li", contains="an"))
    found = parsed(spark, sf, ["li"]).select("page_id", "strings", F.explode(items).alias("item"))
    return found.select("page_id", P.node_text(F.col("item")).alias("text"))


def page_first_inside(spark, sf):
    """The link inside each list item whose text contains the word."""
    items = P.first_inside("nodes", P.where(tag="li", contains="an"), P.where(tag="a"))
    found = parsed(spark, sf, ["li", "a"]).select("page_id", "strings", F.inline(items))
    text = P.node_text(F.col("node")).alias("text")
    return found.select("page_id", text, F.col("found.attrs")["href"].alias("href"))


def page_all_inside(spark, sf):
    """All list items of the first menu, and of each the stripped text of the link inside."""
    items = P.all_inside("nodes", P.where(tag="nav"), P.where(tag="li"))
    cells = P.first_inside("nodes", P.where(tag="li"), P.where(tag="a"), among=items)
    found = parsed(spark, sf, ["nav", "li", "a"]).select("page_id", "strings", F.posexplode(cells))
    link = F.col("col.found")
    return found.select(
        "page_id",
        "pos",
        P.stripped(P.node_text(link)).alias("text"),
        link["attrs"]["href"].alias("href"),
    )


def page_tag_census(spark, sf):
    elements = P.node_rows(parsed(spark, sf, with_text=False)).filter(P.where()(F.struct("tag")))
    return elements.groupBy("tag").agg(
        F.count("*").alias("n"), F.count_if(F.size("attrs") > 0).alias("with_attrs")
    )


def page_errors(spark, sf):
    """How many pages were read whole, broke off, or are null."""
    state = F.when(F.col("nodes").isNull(), "null").when(F.col("error").isNull(), "whole")
    pages = parsed(spark, sf, tags=[], with_text=False)
    return pages.groupBy(state.otherwise("broken off").alias("state")).agg(F.count("*").alias("n"))


# --- Python functions and concurrent actions ------------------------------------------------------


def udf_list(spark, sf):
    """The Python function is evaluated once per pool, after the aggregate."""
    register_versions(spark, "compute")
    return spark.sql(
        "SELECT warehouse_name, n, size(versions) AS versions,"
        " forall(versions, v -> v RLIKE '^[0-9]+[.][0-9]+') AS look_right"
        " FROM (SELECT warehouse_name, count(*) AS n, compute() AS versions"
        " FROM {usage} GROUP BY warehouse_name)",
        usage=views.usage_history(spark, sf),
    )


def concurrent_counts(spark, sf):
    usage = views.usage_history(spark, sf)
    counted = {
        "all": usage,
        "without pool": usage.filter(F.col("warehouse_name").isNull()),
        "working": usage.filter(F.col("execution_time") > 0),
    }
    counts = run_all(spark, {label: rows.count for label, rows in counted.items()})
    return spark.createDataFrame(list(counts.items()), "label string, n bigint")


# --- the driver's dictionaries --------------------------------------------------------------------


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "user_credits": user_credits,
        "user_credits_sql": user_credits_sql,
        "user_credits_rollup": user_credits_rollup,
        "daily_credits": daily_credits,
        "daily_credits_sql": daily_credits_sql,
        "query_shapes": query_shapes,
        "query_shapes_sql": query_shapes_sql,
        "credit_matrix": credit_matrix,
        "log_table_append": log_table_append,
        "log_table_rerun": log_table_rerun,
        "credit_html_rows": credit_html_rows,
        "user_html_rows": user_html_rows,
        "report_fragment": report_fragment,
        "report_page": report_page,
        "sales_select": on_sales(S.sold_times),
        "sales_rename": on_sales(S.renamed),
        "sales_substr": on_sales(S.time_prefix),
        "sales_filter": on_sales(lambda sales: S.cost_at(sales, 510, 3)),
        "sales_filter_or": on_sales(lambda sales: S.cost_at_either(sales, 510, 3)),
        "sales_join_logs": sales_join_logs,
        "sales_sort": on_sales(lambda s: S.with_place(S.by_quantity_then_cost(s, S.TIES))),
        "sales_sort_override": on_sales(lambda s: S.with_place(S.by_quantity_and_cost(s, S.TIES))),
        "sales_totals": on_sales(S.quantity_totals),
        "sales_minmax": on_sales(S.extremes),
        "sales_minmax_dict": on_sales(S.extremes_by_dict),
        "sales_by_date": on_sales(S.by_date),
        "sales_row_number": on_sales(S.numbered),
        "sales_fill_null": on_sales(S.filled),
        "sales_limit_count": sales_limit_count,
        "sales_by_week": sales_by_week,
        "local_rows": local_rows,
        "csv_scan": csv_scan,
        "csv_malformed": csv_malformed,
        "page_elements_by_tag_attr": page_elements_by_tag_attr,
        "page_attr": page_attr,
        "page_first_tag_text": page_first_tag_text,
        "page_exact_text": page_exact_text,
        "page_text_contains": page_text_contains,
        "page_first_inside": page_first_inside,
        "page_all_inside": page_all_inside,
        "page_errors": page_errors,
        "page_tag_census": page_tag_census,
        "udf_list": udf_list,
        "concurrent_counts": concurrent_counts,
    }

    def in_utc(plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The test timestamps have no zone; hours and days are cut in the session's, which a
            # plan fixes when it is made.
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                return plan(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)

        return run

    return {name: in_utc(plan) for name, plan in found.items()} | corpus_queries()


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Those of the operators for training data, none without that part."""
    return {"pipeline": corpus_pipeline.run, **llm.queries()} if llm else {}


SALES = """sales AS (
  SELECT CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER)
           AS cs_sold_date_sk,
         l_orderkey % 86400 AS cs_sold_time_sk, l_suppkey AS cs_bill_cdemo_sk,
         l_partkey AS cs_item_sk, l_orderkey AS cs_order_number, l_linenumber AS cs_line_number,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS cs_quantity,
         CASE WHEN l_linenumber >= 6 THEN NULL
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS cs_wholesale_cost,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS cs_list_price,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(4,0))
           AS cs_ext_wholesale_cost
  FROM lineitem)"""

SALES_LOGS = """sales_logs AS (
  SELECT p_partkey AS cs_item_sk, p_brand AS log_tag FROM part WHERE p_size > 15
  UNION ALL
  SELECT p_partkey, concat(p_type, ' ', p_name) FROM part WHERE p_type = 'ECONOMY')"""

USAGE = """usage_history AS (
  SELECT concat('user_', CAST(user_id AS VARCHAR)) AS user_name,
         CASE WHEN event_type = 'error' THEN NULL
              ELSE concat(upper(event_type), '_WH') END AS warehouse_name,
         ts AS start_time,
         CASE WHEN event_id % 17 = 0 THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END
           AS execution_time,
         CASE WHEN event_id % 13 = 0 THEN 0 ELSE CAST(round(value * 120) AS BIGINT) END
           AS total_elapsed_time,
         concat('select u', CAST(user_id AS VARCHAR), ' from ', event_type, ' limit 100')
           AS query_text
  FROM events)"""

METERING = """metering AS (
  SELECT concat(upper(event_type), '_WH') AS warehouse_name, date_trunc('hour', ts) AS start_time,
         CAST(CASE WHEN extract(day FROM date_trunc('hour', ts)) % 7 = 0 THEN 0
                   ELSE count(*) * 0.25 END AS DECIMAL(18,9)) AS credits_used
  FROM events WHERE event_type <> 'signup' GROUP BY 1, 2)"""

USER_CREDITS = f"""{USAGE}, {METERING},
user_hour AS (
  SELECT user_name, warehouse_name, date_trunc('hour', start_time) AS h, sum(execution_time) AS t
  FROM usage_history
  WHERE warehouse_name IS NOT NULL AND execution_time > 0
    AND start_time > TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 1 MONTH
  GROUP BY 1, 2, 3),
pool_hour AS (SELECT warehouse_name, h, sum(t) AS t FROM user_hour GROUP BY 1, 2),
user_credits AS (
  SELECT user_name, a.warehouse_name,
         CAST(round(round(sum(CAST(a.t AS DOUBLE) * CAST(credits_used AS DOUBLE)
                              / CAST(b.t AS DOUBLE)), 9), 2) AS DECIMAL(18,2))
           AS approximate_credits_used
  FROM user_hour a
  JOIN pool_hour b ON a.h = b.h AND a.warehouse_name = b.warehouse_name
  JOIN metering c ON c.start_time = a.h AND c.warehouse_name = a.warehouse_name
  GROUP BY 1, 2)"""

DAILY_CREDITS = f"""{METERING},
daily AS (
  SELECT start_date, warehouse_name, round(total, 0) AS credits_used_date_wh
  FROM (SELECT CAST(start_time AS DATE) AS start_date, warehouse_name, sum(credits_used) AS total
        FROM metering GROUP BY 1, 2) AS t
  WHERE total > 0 AND start_date > TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 1 MONTH)"""

QUERY_SHAPES = f"""{USAGE},
shapes AS (
  SELECT substr(query_text, 1, 25) AS partial_query_text, count(*) AS number_of_queries,
         CAST(sum(total_elapsed_time) AS DOUBLE) / 60000 AS execution_minutes
  FROM usage_history
  WHERE CAST(start_time AS DATE) > DATE '2024-01-01' AND total_elapsed_time > 0
  GROUP BY 1 HAVING count(*) >= 10
  ORDER BY 2 DESC, 1 LIMIT 20)"""

SHAPE_HTML = r"""concat('<tr><td>', partial_query_text, '</td><td>', number_of_queries, '</td><td>',
  regexp_replace(CAST(CAST(execution_minutes AS DECIMAL(38,6)) AS VARCHAR), '(\.\d+?)0+$', '\1'),
  '</td></tr>')"""

USER_HTML = r"""concat('<tr><td>', user_name, '</td><td>', warehouse_name, '</td><td>',
  regexp_replace(CAST(CAST(approximate_credits_used AS DECIMAL(38,2)) AS VARCHAR),
                 '(\.\d+?)0+$', '\1'),
  '</td></tr>')"""

ITEMS = """regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', {group})"""

# The days of the matrix: the month up to 2024-02-10.
MATRIX_DAYS = [f"2024-01-{day:02d}" for day in range(11, 32)]
MATRIX_DAYS += [f"2024-02-{day:02d}" for day in range(1, 11)]

ORDER_COLUMNS = (
    "cs_order_number, cs_quantity, CAST(cs_wholesale_cost AS DECIMAL(12,2)) AS cs_wholesale_cost,"
    " CAST(cs_list_price AS DECIMAL(12,2)) AS cs_list_price"
)


# The fixed lines of the report by section, in order.
REPORT_LINES = {
    0: """<!DOCTYPE html>
<html>
<head>
<meta charset='utf-8'>
<style>td, th { padding: 0.3em; border-bottom: thin solid gray; }</style>
</head>
<body>
<h2>Utilization Report</h2>
<hr>
<br>
<h3>Approx. Users Credit Consumption Report</h3>
<br>
<table>
<tr><th>USER NAME</th><th>WAREHOUSE NAME</th><th>APPROX. CREDITS USED</th></tr>""",
    2: """</table>
<br>
<h3>Queries by # Executed and their Execution Time</h3>
<br>
<table>
<tr><th>PARTIAL QUERY TEXT</th><th>NUMBER OF QUERIES</th><th>EXECUTION TIME IN MINS</th></tr>""",
    4: """</table>
<br>
<h3>Utilization Report</h3>
<img height=auto width=100% src='cid:img.jpg'></img>
</body>
</html>""",
}


def _fixed_lines() -> str:
    """The fixed lines as rows of (section, place, line)."""
    rows = []
    for section, lines in REPORT_LINES.items():
        for place, line in enumerate(lines.split("\n")):
            text = line.replace("'", "''")
            rows.append(f"({section}, CAST({place} AS DOUBLE), '{text}')")
    return ", ".join(rows)


def _stddev(whole: str, unit: float) -> str:
    """The sample standard deviation by whole numbers: of values in their smallest unit."""
    whole = f"CAST({whole} AS HUGEINT)"
    spread = f"count({whole}) * sum({whole} * {whole}) - sum({whole}) * sum({whole})"
    n = f"CAST(count({whole}) AS DOUBLE)"
    return f"""CASE WHEN count({whole}) > 1
      THEN sqrt(CAST({spread} AS DOUBLE) / ({n} * ({n} - 1))) / CAST({unit} AS DOUBLE) END"""


def _decoded(text: str) -> str:
    """Character references in titles, items and links; the last ``;`` may be missing."""
    return f"""regexp_replace(replace({text}, '&quot;', '"'), '&amp;?', '&', 'g')"""


def oracle_sql() -> dict[str, str]:
    user_credits_sql = f"WITH {USER_CREDITS} SELECT * FROM user_credits"
    daily_columns = (
        "start_date, warehouse_name, CAST(credits_used_date_wh AS DECIMAL(38,0))"
        " AS credits_used_date_wh"
    )
    daily_credits_sql = f"WITH {DAILY_CREDITS} SELECT {daily_columns} FROM daily"
    query_shapes_sql = f"WITH {QUERY_SHAPES} SELECT * FROM shapes"
    logged_sql = f"""WITH {DAILY_CREDITS}
            SELECT {daily_columns} FROM daily
            UNION ALL
            SELECT DATE '2022-11-08', name, CAST(credits AS DECIMAL(38,0))
            FROM (VALUES ('ETL_WH', 433), ('ML_LOAD_WH', 1398), ('ADHOC_WH', 466),
                         ('USER_WH', 245), ('ANALYTICS_WH', 683)) AS v(name, credits)"""
    # The log holds each day once as it is and once at three times the amount.
    matrix = ", ".join(
        f"avg(CAST(credits AS DOUBLE)) FILTER (WHERE start_date = DATE '{day}') AS \"{day}\""
        for day in MATRIX_DAYS
    )
    priced = "cs_quantity IS NOT NULL AND cs_wholesale_cost IS NOT NULL"
    corpus_sql = llm.oracle_sql() if llm else {}
    minmax = f"""WITH {SALES} SELECT min(cs_quantity) AS min_cs_quantity,
        CAST(max(cs_wholesale_cost) AS DECIMAL(12,2)) AS max_cs_wholesale_cost FROM sales"""
    return corpus_sql | {
        "user_credits": user_credits_sql,
        "user_credits_rollup": user_credits_sql,
        "user_credits_sql": f"""WITH {USER_CREDITS}
            SELECT *, row_number() OVER (ORDER BY approximate_credits_used DESC,
                                         user_name NULLS FIRST, warehouse_name) AS place
            FROM user_credits""",
        "daily_credits": daily_credits_sql,
        "daily_credits_sql": daily_credits_sql,
        "query_shapes": query_shapes_sql,
        "query_shapes_sql": query_shapes_sql,
        "credit_matrix": f"""WITH {DAILY_CREDITS},
            log AS (SELECT start_date, warehouse_name, credits_used_date_wh AS credits FROM daily
                    UNION ALL
                    SELECT start_date, warehouse_name, credits_used_date_wh * 3 FROM daily)
            SELECT warehouse_name, {matrix} FROM log GROUP BY warehouse_name""",
        "log_table_append": logged_sql,
        "log_table_rerun": logged_sql,
        "credit_html_rows": f"""WITH {DAILY_CREDITS}
            SELECT concat('<tr><td>', start_date, '</td><td>', warehouse_name, '</td><td>',
                          CAST(credits_used_date_wh AS BIGINT), '</td></tr>') AS html
            FROM daily""",
        "user_html_rows": f"""WITH {USER_CREDITS}
            SELECT user_name, warehouse_name, {USER_HTML} AS html FROM user_credits""",
        "report_fragment": f"""WITH {QUERY_SHAPES}
            SELECT string_agg({SHAPE_HTML}, ''
                              ORDER BY number_of_queries DESC, partial_query_text) AS fragment
            FROM shapes""",
        "report_page": f"""WITH {USER_CREDITS}, {QUERY_SHAPES.removeprefix(USAGE + ",")}
            SELECT section, place, line FROM (VALUES {_fixed_lines()}) AS v(section, place, line)
            UNION ALL
            SELECT 1, 0 - CAST(approximate_credits_used AS DOUBLE), {USER_HTML} FROM user_credits
            UNION ALL
            SELECT 3, CAST(0 - number_of_queries AS DOUBLE), {SHAPE_HTML} FROM shapes""",
        "sales_select": f"WITH {SALES} SELECT cs_sold_time_sk FROM sales",
        "sales_rename": f"""WITH {SALES}
            SELECT cs_sold_time_sk AS column1, cs_bill_cdemo_sk FROM sales""",
        "sales_substr": f"""WITH {SALES}
            SELECT left(CAST(cs_sold_time_sk AS VARCHAR), 3) AS column1 FROM sales""",
        "sales_filter": f"""WITH {SALES}
            SELECT CAST(cs_ext_wholesale_cost AS DECIMAL(17,2)) AS cs_ext_wholesale_cost
            FROM sales WHERE cs_sold_time_sk = 510 AND cs_bill_cdemo_sk = 3""",
        "sales_filter_or": f"""WITH {SALES}
            SELECT cs_order_number, cs_line_number,
                   CAST(cs_ext_wholesale_cost AS DECIMAL(17,2)) AS cs_ext_wholesale_cost
            FROM sales WHERE cs_sold_time_sk = 510 OR cs_bill_cdemo_sk = 3""",
        "sales_join_logs": f"""WITH {SALES}, {SALES_LOGS}
            SELECT s.cs_item_sk, cs_order_number, cs_line_number,
                   CAST(cs_list_price AS DECIMAL(12,2)) AS cs_list_price, log_tag
            FROM sales s JOIN sales_logs l ON s.cs_item_sk = l.cs_item_sk""",
        "sales_sort": f"""WITH {SALES} SELECT {ORDER_COLUMNS}, row_number() OVER (
              ORDER BY sales.cs_quantity ASC, sales.cs_wholesale_cost DESC, cs_order_number,
                       sales.cs_list_price) AS place
            FROM sales WHERE {priced}""",
        "sales_sort_override": f"""WITH {SALES} SELECT {ORDER_COLUMNS}, row_number() OVER (
              ORDER BY sales.cs_quantity ASC, sales.cs_wholesale_cost ASC, cs_order_number,
                       sales.cs_list_price) AS place
            FROM sales WHERE {priced}""",
        "sales_totals": f"""WITH {SALES}
            SELECT CAST(sum(cs_quantity) AS BIGINT) AS qty_sum,
                   {_stddev("cs_quantity", 1)} AS qty_stddev,
                   count(cs_quantity) AS qty_count FROM sales""",
        "sales_minmax": minmax,
        "sales_minmax_dict": minmax,
        "sales_by_date": f"""WITH {SALES}
            SELECT cs_sold_date_sk, CAST(sum(cs_quantity) AS BIGINT) AS qty_sum,
                   {_stddev("cs_wholesale_cost * 100", 100)} AS std_dev
            FROM sales GROUP BY cs_sold_date_sk""",
        "sales_row_number": f"""WITH {SALES}, numbered AS (
              SELECT *, row_number() OVER (
                  ORDER BY cs_sold_date_sk DESC NULLS FIRST, cs_order_number ASC NULLS FIRST,
                           cs_line_number ASC NULLS FIRST, cs_quantity ASC NULLS FIRST,
                           cs_wholesale_cost ASC NULLS FIRST, cs_list_price ASC NULLS FIRST
              ) AS rank FROM sales)
            SELECT rank, {ORDER_COLUMNS} FROM numbered""",
        "sales_fill_null": f"""WITH {SALES}
            SELECT cs_order_number, coalesce(cs_quantity, 111) AS cs_quantity,
                   CAST(cs_wholesale_cost AS DECIMAL(12,2)) AS cs_wholesale_cost,
                   CAST(cs_list_price AS DECIMAL(12,2)) AS cs_list_price
            FROM sales WHERE cs_quantity IS NULL AND cs_wholesale_cost IS NULL""",
        "sales_limit_count": f"""WITH {SALES}
            SELECT count(*) AS n FROM (SELECT * FROM sales LIMIT 20) AS t""",
        "sales_by_week": f"""WITH {SALES},
            span AS (SELECT min(cs_sold_date_sk) AS lo, max(cs_sold_date_sk) AS hi FROM sales),
            weeks AS (SELECT unnest(range(lo, hi + 1, 7)) AS week_start FROM span)
            SELECT week_start, count(*) AS n, CAST(sum(cs_quantity) AS BIGINT) AS qty_sum
            FROM weeks JOIN sales
              ON cs_sold_date_sk >= week_start AND cs_sold_date_sk < week_start + 7
            GROUP BY week_start""",
        "local_rows": f"""WITH {SALES}
            SELECT CAST(col_1 AS BIGINT) AS col_1, col_2, count(*) AS n
            FROM sales JOIN (VALUES (1, 'one'), (2, 'two'), (3, 'three'), (4, 'four'),
                                    (5, 'five'), (6, 'six'), (7, 'seven')) AS v(col_1, col_2)
              ON cs_line_number = col_1
            GROUP BY 1, 2""",
        "csv_scan": """SELECT p_name AS name,
              CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_brand END AS url,
              CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE p_type END AS username,
              CASE WHEN p_partkey % 4 IN (1, 3) THEN NULL
                   ELSE CAST(p_size AS VARCHAR) END AS password
            FROM part""",
        "csv_malformed": """
            SELECT CASE WHEN p_partkey % 4 IN (1, 2) THEN 'malformed' ELSE 'whole' END AS state,
                   count(*) AS n
            FROM part GROUP BY 1""",
        "page_elements_by_tag_attr": f"""
            SELECT page_id,
                   CAST(len(regexp_extract_all(html, '<div class="ad">')) AS INTEGER) AS ads,
                   CASE WHEN contains(html, '<div class="ad">')
                        THEN {_decoded("regexp_extract(html, '<div class=\"ad\">([^<]*)', 1)")}
                        END AS first_ad
            FROM pages""",
        "page_attr": """
            SELECT page_id, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
                   nullif(regexp_extract(html, '<([a-z0-9]+) class="ad"', 1), '') AS ad_tag,
                   nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') AS first_href
            FROM pages""",
        "page_first_tag_text": f"""
            SELECT page_id,
                   {_decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title
            FROM pages""",
        "page_exact_text": """
            SELECT page_id,
                   CASE WHEN contains(html, '>The<') THEN 'The' END AS first_match,
                   CAST(len(regexp_extract_all(html, '>The<')) AS INTEGER) AS matches
            FROM pages""",
        "page_text_contains": f"""
            SELECT page_id, text FROM (
              SELECT page_id, {_decoded("unnest(" + ITEMS.format(group=1) + ")")} AS text FROM pages
            ) AS items
            WHERE contains(text, 'an')""",
        "page_first_inside": f"""
            SELECT page_id, text, href FROM (
              SELECT page_id, {_decoded("regexp_extract(item, '>([^<]*)</a>', 1)")} AS text,
                     {_decoded("regexp_extract(item, 'href=\"([^\"]*)\"', 1)")} AS href
              FROM (SELECT page_id, unnest({ITEMS.format(group=0)}) AS item FROM pages) AS t
            ) AS items
            WHERE contains(text, 'an')""",
        "page_all_inside": f"""
            SELECT page_id, CAST(pos AS INTEGER) AS pos,
                   trim({_decoded("regexp_extract(item, '>([^<]*)</a>', 1)")}) AS text,
                   {_decoded("regexp_extract(item, 'href=\"([^\"]*)\"', 1)")} AS href
            FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos
                  FROM (SELECT page_id, regexp_extract_all(
                          regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'),
                          '<li><a href="[^"]*">[^<]*</a></li>') AS items FROM pages) AS n) AS t""",
        "page_errors": """
            SELECT CASE WHEN html IS NULL THEN 'null' ELSE 'whole' END AS state, count(*) AS n
            FROM pages GROUP BY 1""",
        "page_tag_census": r"""
            SELECT regexp_extract(tag, '<([a-z][a-z0-9]*)', 1) AS tag, count(*) AS n,
                   count(*) FILTER (WHERE contains(tag, '="')) AS with_attrs
            FROM (SELECT unnest(regexp_extract_all(
                    regexp_replace(html, '<script>.*?</script>', '<script></script>', 'gs'),
                    '<[a-z][a-z0-9]*[^>]*>')) AS tag FROM pages) AS t
            GROUP BY 1""",
        "udf_list": f"""WITH {USAGE}
            SELECT warehouse_name, count(*) AS n, 2 AS versions, TRUE AS look_right
            FROM usage_history GROUP BY warehouse_name""",
        "concurrent_counts": f"""WITH {USAGE}
            SELECT 'all' AS label, count(*) AS n FROM usage_history
            UNION ALL
            SELECT 'without pool', count(*) FROM usage_history WHERE warehouse_name IS NULL
            UNION ALL
            SELECT 'working', count(*) FROM usage_history WHERE execution_time > 0""",
    }
