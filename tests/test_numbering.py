import re
from random import Random

import pytest
from conftest import executed_plan, failing_once
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.operators.numbering import global_row_number
from creditloom.operators.ordering import sort_spread
from creditloom.plans import sales as S
from creditloom.sources import views


def order():
    return [F.col("k").desc_nulls_first(), F.col("t").asc()]


def literal(df):
    return df.withColumn("n", F.row_number().over(Window.orderBy(*order())))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_single_task_window(spark, seed):
    rng = Random(seed)
    rows = [(rng.choice([None, *range(5)]), i) for i in range(rng.choice([1, 37, 2000]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, t int")
    assert sorted(global_row_number(df, order(), "n").collect(), key=lambda r: r["n"]) == sorted(
        literal(df).collect(), key=lambda r: r["n"]
    )


def test_empty(spark):
    df = spark.createDataFrame([], "k int, t int")
    assert global_row_number(df, order(), "n").count() == 0


def test_one_key_and_copies_are_spread(spark, tmp_path, conf):
    """A third of the rows share a key, another third are copies of one row."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    n = 90_000
    kind = F.col("id") % 3
    df = spark.range(0, n, 1, 8).select(
        F.when(kind < 2, 3).otherwise(F.col("id") % 7).cast("int").alias("k"),
        F.when(kind == 0, 5).otherwise(F.col("id")).cast("int").alias("t"),
    )
    df.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    numbered = global_row_number(stored, order(), "n")
    assert [r["n"] for r in numbered.select("n").orderBy("n").collect()] == list(range(1, n + 1))
    out_of_order = (
        numbered.alias("a")
        .join(numbered.alias("b"), F.col("a.n") + 1 == F.col("b.n"))
        .filter("a.k < b.k OR (a.k = b.k AND a.t > b.t)")
    )
    assert out_of_order.count() == 0
    sizes = [size for size in numbered.rdd.glom().map(len).collect() if size]
    assert len(sizes) > 4 and max(sizes) < n / 3


def test_a_lost_task_changes_nothing(spark, tmp_path):
    spark.range(0, 40_000, 1, 8).selectExpr("id % 5 AS k", "0 AS t", "id").write.parquet(
        str(tmp_path / "rows")
    )
    stored = spark.read.parquet(str(tmp_path / "rows"))
    numbered = global_row_number(failing_once(stored, 3), order(), "n", from_scan=True).collect()
    assert sorted(r["n"] for r in numbered) == list(range(1, 40_001))
    assert sorted(r["id"] for r in numbered) == list(range(40_000))
    in_order = sorted(numbered, key=lambda r: r["n"])
    assert [r["k"] for r in in_order] == sorted((r["k"] for r in numbered), reverse=True)


def test_a_lost_task_after_a_shuffle_changes_nothing(spark):
    """Rows of a join come in another order when a task is run again."""
    left = spark.range(0, 20_000, 1, 8).selectExpr("id % 5 AS k", "0 AS t", "id")
    right = spark.range(5).selectExpr("id AS k", "id AS other")
    joined = left.repartition(8, "id").join(right.hint("shuffle_hash"), "k")
    frame = failing_once(joined.repartition(8).select("k", "t", "id"), 3)
    numbered = global_row_number(frame, order(), "n").collect()
    assert sorted(r["n"] for r in numbered) == list(range(1, 20_001))
    assert sorted(r["id"] for r in numbered) == list(range(20_000))
    assert [r["k"] for r in sort_spread(frame, F.desc("k")).collect()] == sorted(
        (r["k"] for r in numbered), reverse=True
    )


def test_no_row_passes_through_one_task(spark, sf_dir):
    """Only the partition sizes meet in a single task."""
    plan = executed_plan(S.numbered(views.sales(spark, sf_dir)))
    below_single = plan[plan.index("SinglePartition") :]
    first = next(line for line in below_single.splitlines()[1:] if "HashAggregate" in line)
    assert re.search(r"HashAggregate\(keys=\[_rank_part", first)
