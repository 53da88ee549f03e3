"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import at, executed_plan
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from creditloom.plans import report_sql, reports
from creditloom.plans import sales as S
from creditloom.sources import views

CORPUS = entry_module.corpus_queries()
QUERIES = {name: plan for name, plan in entry_module.queries().items() if name not in CORPUS}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark, sf_dir):
    usage = views.usage_history(spark, sf_dir)
    plan = executed_plan(reports.query_shapes(usage, at("2024-02-01")))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in plan
    plan = executed_plan(S.cost_at(views.sales(spark, sf_dir), 510, 3))
    assert "EqualTo(l_suppkey,3)" in plan
    columns = "l_orderkey:bigint,l_suppkey:bigint,l_quantity:double,l_extendedprice:double"
    assert f"ReadSchema: struct<{columns}>" in plan


def test_metering_bounds_reach_the_scan(spark, sf_dir, tmp_path):
    ntz = F.col("start_time").cast("timestamp_ntz")
    views.metering(spark, sf_dir).withColumn("start_time", ntz).write.parquet(str(tmp_path / "m"))
    metering = spark.read.parquet(str(tmp_path / "m"))
    usage = views.usage_history(spark, sf_dir)
    assert "GreaterThanOrEqual(start_time,2024-01-11T00:00)" in executed_plan(
        reports.daily_credits(metering, at("2024-02-10"))
    )
    tables = {"usage": usage, "metering": metering}
    for credits in (
        reports.user_credits(usage, metering, at("2024-02-10")),
        report_sql.run_report(spark, report_sql.USER_CREDITS, at("2024-02-10"), tables),
    ):
        lines = executed_plan(credits).splitlines()
        pushed = [line for line in lines if "credits_used" in line and "FileScan" in line]
        assert pushed and "GreaterThanOrEqual(start_time,2024-01-10T00:00" in pushed[0]
    for shapes in (
        reports.query_shapes(usage, at("2024-02-01")),
        report_sql.run_report(
            spark, report_sql.QUERY_SHAPES, at("2024-02-01"), tables, at_least=10, top=20
        ),
    ):
        assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in executed_plan(shapes)
    daily = report_sql.run_report(spark, report_sql.DAILY_CREDITS, at("2024-02-10"), tables)
    assert "GreaterThanOrEqual(start_time,2024-01-11T00:00)" in executed_plan(daily)


def test_top_k_is_not_a_sort(spark, sf_dir):
    plan = executed_plan(reports.query_shapes(views.usage_history(spark, sf_dir), at("2024-02-01")))
    assert "TakeOrderedAndProject(limit=20" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("text", [False, True])
def test_history_is_shuffled_once(spark, sf_dir, text):
    usage, metering = views.usage_history(spark, sf_dir), views.metering(spark, sf_dir)
    if text:
        tables = {"usage": usage, "metering": metering}
        df = report_sql.run_report(spark, report_sql.USER_CREDITS, at("2024-02-10"), tables)
    else:
        df = reports.user_credits(usage, metering, at("2024-02-10"))
    assert "ReusedExchange" in executed_plan(df)


def test_hot_hours_are_salted_unless_the_side_is_small(spark, sf_dir, conf):
    usage, metering = views.usage_history(spark, sf_dir), views.metering(spark, sf_dir)
    small = executed_plan(reports.user_shares(usage, metering, at("2024-02-10")))
    assert re.search(r"BroadcastHashJoin \[.*_salt", small)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    large = executed_plan(reports.user_shares(usage, metering, at("2024-02-10")))
    # At most the table of hot keys is broadcast, whose size is bounded; here there are none.
    assert "BroadcastHashJoin" not in large and "ReusedExchange" in large
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[.*_salt", large)


def test_no_job_before_the_action(spark, sf_dir):
    """Only queries whose feature is a write, a count or a sorted place may run jobs at once."""
    eager = {
        "credit_matrix", "log_table_append", "csv_scan", "concurrent_counts", "sales_row_number",
        "sales_sort", "sales_sort_override", "user_credits_sql", "sales_by_week", "csv_malformed",
        "log_table_rerun", "user_credits_rollup",
    }
    # The tables' columns are compared once.
    for name in views.TABLES:
        views.read_table(spark, sf_dir, name)
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(QUERIES) - eager):
        spark.sparkContext.setJobGroup(f"plan {name}", name)
        QUERIES[name](spark, sf_dir)
        assert not tracker.getJobIdsForGroup(f"plan {name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def skewed_sales(spark, sf_dir):
    """A third of the sales are of one item."""
    item = F.when(F.col("cs_order_number") % 3 == 0, 1).otherwise(F.col("cs_item_sk"))
    return views.sales(spark, sf_dir).withColumn("cs_item_sk", item.cast("bigint"))


def test_hot_item_is_split(spark, sf_dir, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    # A small test file is one split, and a hot partition is cut along the splits it came from.
    sold, logs = skewed_sales(spark, sf_dir).repartition(8), views.sales_logs(spark, sf_dir)
    joined = S.joined_logs(sold, logs)
    assert "SortMergeJoin(skew=true)" in executed_plan(joined)
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    assert S.joined_logs(sold, logs).exceptAll(joined).count() == 0
