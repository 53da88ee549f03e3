import statistics
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from creditloom.operators.aggregates import by_name, exact_stddev
from creditloom.operators.ordering import directed, sort_spread
from creditloom.plans import sales as S
from creditloom.sources import views

SALES = (
    "cs_sold_date_sk int, cs_sold_time_sk bigint, cs_bill_cdemo_sk bigint, cs_item_sk bigint,"
    " cs_order_number bigint, cs_line_number int, cs_quantity int, cs_wholesale_cost decimal(12,2),"
    " cs_list_price decimal(12,2), cs_ext_wholesale_cost decimal(17,2)"
)


def sale(date=1, time=46616, cdemo=3, item=1, order=1, line=1, quantity=2, cost="5"):
    price = Decimal(cost or "8")
    return (date, time, cdemo, item, order, line, quantity, cost and price, price, price * 2)


@pytest.fixture(scope="module")
def all_sales(spark, sf_dir):
    return views.sales(spark, sf_dir)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SALES)


def test_prefix_of_a_number(spark):
    df = S.time_prefix(frame(spark, sale(time=46616), sale(time=7), sale(time=None)))
    assert [r[0] for r in df.collect()] == ["466", "7", None]


def test_filters(spark):
    keys = [(510, 3), (510, 4), (9, 3), (None, 3), (None, 9)]
    df = frame(spark, *[sale(time=time, cdemo=cdemo) for time, cdemo in keys])
    assert S.cost_at(df, 510, 3).count() == 1
    assert S.cost_at_either(df, 510, 3).count() == 4


def test_join_multiplies_and_drops(spark):
    sold = frame(spark, sale(item=1), sale(item=1), sale(item=2), sale(item=None), sale(item=5))
    logs = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (3, "w"), (None, "n"), (5, "v")],
                                 "cs_item_sk bigint, log_tag string")
    rows = S.joined_logs(sold, logs).collect()
    assert sorted((r["cs_item_sk"], r["log_tag"]) for r in rows) == sorted(
        [(1, tag) for tag in "xyz"] * 2 + [(5, "v")]
    )


def keys(df):
    return [(r["cs_quantity"], r["cs_wholesale_cost"]) for r in df.collect()]


def test_sort_directions(all_sales):
    mixed = keys(S.by_quantity_then_cost(all_sales))
    assert mixed == sorted(mixed, key=lambda k: (k[0], -k[1])) and len(mixed) > 1000
    up = keys(S.by_quantity_and_cost(all_sales))
    assert up == sorted(up) and sorted(mixed) == up


def test_flags_decide(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (0, 9)], "a int, b int")
    order = directed({"a": 0, "b": 1})
    assert [tuple(r) for r in df.orderBy(*order).collect()] == [(1, 2), (1, 3), (0, 9)]


def test_ties_keep_scan_order_and_are_spread(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(0, 100_000, 1, 8).selectExpr("id", "1 AS same")
    ordered = sort_spread(df, df["same"], from_scan=True)
    assert [r["id"] for r in ordered.collect()] == list(range(100_000))
    sizes = ordered.rdd.glom().map(len).collect()
    assert len([s for s in sizes if s]) > 1


def test_totals(spark):
    df = frame(spark, sale(quantity=1), sale(quantity=3), sale(quantity=None))
    row = S.quantity_totals(df).first()
    assert (row["qty_sum"], row["qty_count"]) == (4, 2)
    assert row["qty_stddev"] == pytest.approx(2**0.5)  # of the sample


def test_extremes_by_pairs_and_dict(spark):
    df = frame(spark, sale(quantity=4, cost="1"), sale(quantity=2, cost="7"), sale(quantity=None))
    expected = (2, Decimal("7.00"))
    assert tuple(S.extremes(df).first()) == tuple(S.extremes_by_dict(df).first()) == expected
    both = df.agg(*by_name(("cs_quantity", "min"), ("cs_quantity", "max"), {"cs_item_sk": "count"}))
    assert both.columns == ["min_cs_quantity", "max_cs_quantity", "count_cs_item_sk"]
    assert tuple(both.first()) == (2, 4, 3)


def test_group_of_one_has_no_deviation(spark):
    df = S.by_date(frame(spark, sale(date=1), sale(date=2, cost="3"), sale(date=2, cost="5")))
    found = {r["cs_sold_date_sk"]: (r["qty_sum"], r["std_dev"]) for r in df.collect()}
    assert found == {1: (2, None), 2: (4, pytest.approx(2**0.5))}


def test_fill_leaves_other_columns(spark):
    missing = [sale(quantity=None, cost=None), sale(quantity=None), sale(cost=None)]
    df = S.filled(frame(spark, *missing))
    assert [tuple(r)[1:3] for r in df.collect()] == [(111, None)]


def test_fill_keeps_the_type(spark):
    df = S.filled(frame(spark, sale(quantity=None, cost=None)), 7.9)
    assert df.first()["cs_quantity"] == 7


def deviations(df):
    return df.agg(*[exact_stddev(df, name).alias(name) for name in df.columns]).first()


def test_deviation_is_the_same_for_any_partitions(spark):
    some = Random(4)
    rows = [
        (some.choice([None, some.randint(-9, 10**6)]), Decimal(some.randint(-(10**9), 10**9)).scaleb(-2), 5)
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "a int, b decimal(12,2), c bigint")
    found = {tuple(deviations(df.repartition(n))) for n in (1, 7, 200)}
    found |= {tuple(deviations(df.orderBy(F.rand(n)))) for n in (1, 2)}
    ((a, b, c),) = found
    assert a == pytest.approx(statistics.stdev(r[0] for r in rows if r[0] is not None), rel=1e-12)
    assert b == pytest.approx(statistics.stdev(float(r[1]) for r in rows), rel=1e-12)
    assert c == 0


def test_deviation_of_few_and_large_values(spark):
    schema = "a bigint, b decimal(12,2)"
    one = spark.createDataFrame([(1, Decimal("2.50")), (None, None)], schema)
    assert tuple(deviations(one)) == (None, None)
    assert tuple(deviations(one.limit(0))) == (None, None)
    two = spark.createDataFrame([(10**9, Decimal("9999999999.99")), (10**9 + 2, Decimal("9999999999.97"))], schema)
    assert deviations(two)["a"] == pytest.approx(2**0.5, rel=1e-15)
    assert deviations(two)["b"] == pytest.approx(0.02 / 2**0.5, rel=1e-12)
    # Products beyond 38 digits: still a result, still the same for any order.
    huge = spark.createDataFrame([(4 * 10**17 - i * 10**16, Decimal(i)) for i in range(40)], schema)
    assert deviations(huge)["a"] == pytest.approx(statistics.stdev(i * 1e16 for i in range(40)), rel=1e-6)
    assert len({deviations(huge.repartition(n))["a"] for n in (1, 3, 11)}) == 1
