import threading
import time

import numpy
import pandas
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from creditloom.functions.versions import register_versions
from creditloom.operators.concurrent import collect_nowait, run_all, start_all, stream_nowait


def test_function_from_sql(spark):
    register_versions(spark, "compute")
    df = spark.sql("select compute() as versions")
    assert df.schema.simpleString() == "struct<versions:array<string>>"
    assert df.collect()[0][0] == [numpy.__version__, pandas.__version__]


def test_collect_nowait(spark):
    future = collect_nowait(spark.range(3).orderBy("id"), "three")
    assert [r["id"] for r in future.result(timeout=60)] == [0, 1, 2]


def test_collect_nowait_is_bounded(spark):
    assert len(collect_nowait(spark.range(3), "fits", at_most=3).result(timeout=60)) == 3
    with pytest.raises(ValueError, match="more than 2 rows"):
        collect_nowait(spark.range(3), "too many", at_most=2).result(timeout=60)


def test_actions_overlap(spark):
    """Each waits for the other two, so they only end when all run at once."""
    barrier = threading.Barrier(3, timeout=60)

    def action():
        barrier.wait()
        return spark.range(1000).count()

    started = start_all(spark, {name: action for name in "abc"})
    assert [started[name].result() for name in "abc"] == [1000] * 3


def test_failure_stays_with_its_action(spark):
    def bad():
        return spark.sql("select * from no_such_table").collect()

    started = start_all(spark, {"good": spark.range(2).count, "bad": bad})
    assert started["good"].result() == 2
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        started["bad"].result()


def test_tags_are_per_action(spark):
    def tags():
        time.sleep(0.2)
        return spark.getTags()

    started = start_all(spark, {"x": tags, "y": tags})
    assert started["x"].result() == {"x"} and started["y"].result() == {"y"}
    assert spark.getTags() == set()


def test_results_as_rows_pandas_and_text(spark, sf_dir, capsys):
    """A bounded result may come to the driver: as rows, as a pandas frame, or printed."""
    shapes = queries()["query_shapes"](spark, sf_dir)
    frame = shapes.toPandas()
    assert len(frame) == len(shapes.collect()) == 20
    assert list(frame.columns) == shapes.columns
    shapes.show(5)
    assert "only showing top 5 rows" in capsys.readouterr().out


def test_lazy_until_an_action(spark):
    """A bad row fails when collected, not when the frame is built."""
    df = spark.range(3).select((F.lit(1) / (F.col("id") - 1)).alias("x"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.collect()


def slow_count(spark, seconds=120):
    """A job that takes that long, unless it is interrupted."""

    def wait(batches):
        for batch in batches:
            time.sleep(seconds)
            yield batch

    return lambda: spark.range(4, numPartitions=2).mapInArrow(wait, "id bigint").count()


def test_run_all(spark):
    found = run_all(spark, {"a": spark.range(3).count, "b": lambda: spark.range(5).first()[0]})
    assert found == {"a": 3, "b": 0}
    assert run_all(spark, {}) == {}


def test_the_first_failure_stops_the_others(spark):
    def bad():
        time.sleep(2)
        return spark.sql("select * from no_such_table").collect()

    start = time.monotonic()
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        run_all(spark, {"slow": slow_count(spark), "bad": bad})
    assert time.monotonic() - start < 60
    assert spark.range(7).count() == 7


def test_stream_gives_all_rows_in_order(spark):
    rows = spark.range(0, 5000, 1, 7)
    with stream_nowait(rows, "all", ahead=10) as stream:
        assert [r["id"] for r in stream] == list(range(5000))
    assert list(stream) == []
    assert list(stream_nowait(spark.range(0), "none")) == []


def test_stream_starts_before_the_last_partition_is_done(spark):
    def wait(batches):
        from pyspark import TaskContext

        for batch in batches:
            time.sleep(0 if TaskContext.get().partitionId() < 2 else 120)
            yield batch

    start = time.monotonic()
    with stream_nowait(spark.range(0, 400, 1, 4).mapInArrow(wait, "id bigint"), "slow end") as stream:
        assert [next(stream)["id"] for _ in range(100)] == list(range(100))
    # Left early: what is still running is interrupted.
    stream.future.result(timeout=60)
    assert time.monotonic() - start < 60


def test_stream_raises_the_error_of_its_query(spark):
    rows = spark.range(0, 100, 1, 4).select((F.lit(1) / (F.col("id") - 60)).alias("x"))
    stream = stream_nowait(rows, "bad row")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        list(stream)
    assert list(stream) == []
