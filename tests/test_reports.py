import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pandas as pd
import pytest
from conftest import METERING, USAGE, at, executed_plan
from pyspark.sql import functions as F

from creditloom.functions.text import float_text, html_row
from creditloom.operators.joins import join_hot_keys, key_counts
from creditloom.plans import report_sql, reports
from creditloom.sources import rollup


def usage_row(
    user="ann", pool="A_WH", start="2024-01-15 10:30:00", time=100, elapsed=100, text="q"
):
    return (user, pool, at(start), time, elapsed, text)


def meter_row(pool="A_WH", start="2024-01-15 10:00:00", credits="1"):
    return (pool, at(start), Decimal(credits))


def credits_of(spark, usage, metering, as_of="2024-02-10", **options):
    shares = reports.user_shares(
        spark.createDataFrame(usage, USAGE), spark.createDataFrame(metering, METERING),
        at(as_of), **options,
    )
    return {(r[0], r[1]): float(r[2]) for r in shares.collect()}


def test_hour_is_shared_by_time(spark):
    usage = [usage_row("ann", time=300), usage_row("bob", time=100, start="2024-01-15 10:59:59")]
    assert credits_of(spark, usage, [meter_row(credits="8")]) == {
        ("ann", "A_WH"): 6.0, ("bob", "A_WH"): 2.0,
    }


def test_rows_that_do_not_count(spark):
    usage = [
        usage_row("ann"),
        usage_row("no pool", pool=None),
        usage_row("no time", time=0),
        usage_row("null time", time=None),
        usage_row("bound itself", start="2024-01-10 00:00:00"),
        usage_row("before", start="2024-01-09 23:59:59"),
        usage_row("unmetered hour", start="2024-01-15 11:00:00"),
        usage_row("unmetered pool", pool="B_WH"),
    ]
    metering = [meter_row(), meter_row(start="2024-01-10 00:00:00"), meter_row(pool=None)]
    assert credits_of(spark, usage, metering) == {("ann", "A_WH"): 1.0}


def test_first_hour_of_the_period_is_priced(spark):
    """The hour that holds the lower bound starts before it."""
    usage = [usage_row(start="2024-01-10 06:45:00")]
    metering = [meter_row(start="2024-01-10 06:00:00", credits="2")]
    assert credits_of(spark, usage, metering, "2024-02-10 06:30:00") == {("ann", "A_WH"): 2.0}


def test_two_meter_rows_for_an_hour_both_count(spark):
    metering = [meter_row(credits="1"), meter_row(credits="0.5")]
    assert credits_of(spark, [usage_row()], metering) == {("ann", "A_WH"): 1.5}


def test_unknown_user_keeps_its_share(spark):
    usage = [usage_row(None), usage_row("ann")]
    assert credits_of(spark, usage, [meter_row()])[(None, "A_WH")] == 0.5


@pytest.mark.parametrize("part_rows", [3, 10**6])
def test_credits_against_brute_force(spark, part_rows):
    """A third of the rows fall into one hour of one pool."""
    rng = Random(7)
    usage, metering = [], []
    for hour in range(24):
        for pool in "ABC":
            if rng.random() < 0.8:
                start = f"2024-01-20 {hour:02d}:00:00"
                metering.append(meter_row(f"{pool}_WH", start, str(rng.randint(1, 40) / 4)))
    for i in range(3000):
        hot = i % 3 == 0
        pool, hour = ("A", 9) if hot else (rng.choice("ABC"), rng.randrange(24))
        start = f"2024-01-20 {hour:02d}:{rng.randrange(60):02d}:00"
        usage.append(usage_row(f"u{rng.randrange(40)}", f"{pool}_WH", start, rng.randint(1, 999)))

    per_user, per_hour = defaultdict(int), defaultdict(int)
    for user, pool, start, time, _, _ in usage:
        hour = start.replace(minute=0)
        per_user[user, pool, hour] += time
        per_hour[pool, hour] += time
    price = {(pool, start): float(credits) for pool, start, credits in metering}
    expected = defaultdict(float)
    for (user, pool, hour), time in per_user.items():
        if (pool, hour) in price:
            expected[user, pool] += time / per_hour[pool, hour] * price[pool, hour]

    actual = credits_of(spark, usage, metering, part_rows=part_rows)
    assert actual == {key: pytest.approx(value, abs=0.0051) for key, value in expected.items()}


def test_cents_are_exact_in_every_plan(spark, conf):
    """Sums that end in half a cent, by the broadcast, the salted and the SQL plan."""
    rng = Random(3)
    usage, metering, expected = [], [], defaultdict(Decimal)
    for hour in range(24):
        for pool in "AB":
            start = f"2024-01-20 {hour:02d}:00:00"
            # 200 parts of an hour that costs one credit: each is half a cent.
            metering.append(meter_row(f"{pool}_WH", start, "1"))
            left = 200
            for user in range(60):
                parts = rng.randint(0, 5)
                left -= parts
                if parts:
                    usage.append(usage_row(f"u{user}", f"{pool}_WH", start, parts))
                    expected[f"u{user}", f"{pool}_WH"] += parts * Decimal("0.005")
            usage.append(usage_row("rest", f"{pool}_WH", start, left))
            expected["rest", f"{pool}_WH"] += left * Decimal("0.005")
    # Thirds of an hour that costs 1.5 cents make half cents again.
    for minute in range(3):
        usage += [usage_row(f"third{i}", "C_WH", f"2024-01-20 0{minute}:30:00", 7) for i in range(3)]
        metering.append(meter_row("C_WH", f"2024-01-20 0{minute}:00:00", "0.015"))
    expected |= {(f"third{i}", "C_WH"): Decimal("0.015") for i in range(3)}
    rounded = {key: value.quantize(Decimal("0.01"), ROUND_HALF_UP) for key, value in expected.items()}
    assert sum(value != rounded[key] for key, value in expected.items()) > 20
    frames = spark.createDataFrame(usage, USAGE), spark.createDataFrame(metering, METERING)
    tables = dict(zip(("usage", "metering"), frames))
    for threshold in ("-1", "10MB"):
        conf(spark__sql__autoBroadcastJoinThreshold=threshold)
        plans = [reports.user_shares(*frames, at("2024-02-10"), part_rows=n) for n in (5, 10**6)]
        plans.append(report_sql.run_report(spark, report_sql.USER_CREDITS, at("2024-02-10"), tables))
        for plan in plans:
            assert {(r[0], r[1]): r[2] for r in plan.collect()} == rounded


def test_user_credits_are_in_order(spark):
    usage = [usage_row("b"), usage_row("a"), usage_row("c", time=300)]
    frames = spark.createDataFrame(usage, USAGE), spark.createDataFrame([meter_row()], METERING)
    rows = reports.user_credits(*frames, at("2024-02-10")).collect()
    assert [r["user_name"] for r in rows] == ["c", "a", "b"]


def daily(spark, metering, as_of):
    df = reports.daily_credits(spark.createDataFrame(metering, METERING), at(as_of))
    return sorted((str(r[0]), r[1], int(r[2])) for r in df.collect())


def test_daily_credits_keep_what_rounds_to_zero(spark):
    """Positive is asked before rounding, and .5 is rounded away from zero."""
    metering = [
        meter_row("A_WH", credits="0.25"),
        meter_row("B_WH", credits="0"),
        meter_row("C_WH", credits="1.25"), meter_row("C_WH", "2024-01-15 23:00:00", "1.25"),
    ]
    assert daily(spark, metering, "2024-02-10") == [
        ("2024-01-15", "A_WH", 0), ("2024-01-15", "C_WH", 3),
    ]


@pytest.mark.parametrize("as_of", ["2024-02-10 00:00:00", "2024-02-10 15:30:00"])
def test_daily_credits_start_after_the_bounds_day(spark, as_of):
    metering = [meter_row(start=f"2024-01-{day} 20:00:00") for day in ("09", "10", "11")]
    assert daily(spark, metering, as_of) == [("2024-01-11", "A_WH", 1)]


def test_month_end_is_clamped(spark):
    metering = [meter_row(start=f"2024-02-{day} 00:00:00") for day in ("28", "29")]
    metering.append(meter_row(start="2024-03-01 00:00:00"))
    assert daily(spark, metering, "2024-03-31") == [("2024-03-01", "A_WH", 1)]


def shapes(spark, rows, **options):
    usage = spark.createDataFrame(rows, USAGE)
    df = reports.query_shapes(usage, at("2024-02-01 12:00:00"), **options)
    return [tuple(r) for r in df.collect()]


def test_query_shapes(spark):
    long = "select something from a_table where x = "
    rows = [usage_row(text=long + str(i), elapsed=60_000) for i in range(3)]
    rows += [usage_row(text="b", elapsed=90_000)] * 2 + [usage_row(text="a", elapsed=30_000)] * 2
    rows += [usage_row(text="rare"), usage_row(text="b", elapsed=0)]
    rows += [usage_row(text="b", start="2024-01-01 23:00:00")]  # the bound's own day
    assert shapes(spark, rows, at_least=2) == [(long[:25], 3, 3.0), ("a", 2, 1.0), ("b", 2, 3.0)]
    assert shapes(spark, rows, at_least=2, top=1) == [(long[:25], 3, 3.0)]
    assert shapes(spark, rows) == []


def test_sql_text_gives_the_same(spark):
    usage = spark.createDataFrame([usage_row("ann", time=i + 1) for i in range(12)], USAGE)
    metering = spark.createDataFrame([meter_row(credits="2.5")], METERING)
    now, views = at("2024-02-10"), {"usage": usage, "metering": metering}
    run = report_sql.run_report
    pairs = [
        (
            run(spark, report_sql.USER_CREDITS, now, views),
            reports.user_credits(usage, metering, now),
        ),
        (run(spark, report_sql.DAILY_CREDITS, now, views), reports.daily_credits(metering, now)),
        (
            run(spark, report_sql.QUERY_SHAPES, now, views, at_least=10, top=20),
            reports.query_shapes(usage, now),
        ),
    ]
    for text, frame in pairs:
        assert text.schema.simpleString() == frame.schema.simpleString()
        assert text.collect() == frame.collect() != []


def test_zoned_timestamps_work_too(spark):
    zoned = spark.createDataFrame([meter_row()], METERING).withColumn(
        "start_time", F.col("start_time").cast("timestamp")
    )
    usage = spark.createDataFrame([usage_row()], USAGE)
    assert reports.daily_credits(zoned, at("2024-02-10")).count() == 1
    assert reports.user_shares(usage, zoned, at("2024-02-10")).collect()[0][2] == 1


def test_matrix_equals_pandas(spark):
    rows = [
        ("2024-01-02", "A", 4), ("2024-01-02", "A", 7), ("2024-01-01", "B", 1),
        ("2024-01-03", "B", None), (None, "A", 5), ("2024-01-01", None, 9),
        ("2024-01-02", "C", None),
    ]
    names = ["start_date", "warehouse_name", "credits_used_date_wh"]
    log = spark.createDataFrame(rows, "start_date string, warehouse_name string,"
                                " credits_used_date_wh int")  # fmt: skip
    expected = pd.pivot_table(
        pd.DataFrame(rows, columns=names),
        values=names[2], index=names[1], columns=names[0],
    )
    matrix = reports.credit_matrix(log).toPandas().set_index("warehouse_name").sort_index()
    assert list(matrix.columns) == list(expected.columns)
    assert matrix.fillna(-1).values.tolist() == expected.fillna(-1).values.tolist()
    given = reports.credit_matrix(log, ["2024-01-02"])
    assert given.columns == ["warehouse_name", "2024-01-02"]


@pytest.mark.parametrize(
    "value", [0.0, 0.07, 0.1, 1.0, 12.5, 100.0, 12345678.9, 99999999.99, 1e15]
)
def test_float_text_is_pythons(spark, value):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(float_text(F.col("x"), 2)).first()[0] == repr(value)


def test_html_row(spark):
    df = spark.createDataFrame([("a<b & c", None, 3)], "x string, y string, z bigint")
    cells = F.col("x"), F.col("y"), F.col("z")
    row = df.select(html_row(*cells), html_row(*cells, escaped=True)).first()
    assert row[0] == "<tr><td>a<b & c</td><td>None</td><td>3</td></tr>"
    assert row[1] == "<tr><td>a&lt;b &amp; c</td><td>None</td><td>3</td></tr>"


def test_report_is_written_in_order(spark, tmp_path):
    usage = [usage_row(f"u{i}", time=i + 1, text="same") for i in range(40)]
    usage_df = spark.createDataFrame(usage, USAGE)
    shares = reports.user_shares(
        usage_df, spark.createDataFrame([meter_row(credits="100")], METERING), at("2024-02-10")
    )
    found = reports.query_shapes(usage_df, at("2024-02-10"))
    lines = reports.report_lines(shares, found, title="My Report", image="x.png")
    reports.write_report(lines, str(tmp_path / "report"))
    parts = sorted((tmp_path / "report").glob("part-*"))
    text = [line for part in parts for line in part.read_text().splitlines()]
    assert text[0] == "<!DOCTYPE html>" and text[-1] == "</html>"
    users = [line for line in text if "<td>u" in line]
    assert len(users) == 40 and users[0].startswith("<tr><td>u39<") and "<td>u0<" in users[-1]
    assert text.index(users[-1]) < text.index("<tr><td>same</td><td>40</td><td>0.066667</td></tr>")
    assert "<h2>My Report</h2>" in text
    assert "<img height=auto width=100% src='cid:x.png'></img>" in text


def test_fragment_keeps_the_order(spark):
    rows = [("b", 5, 1.0), ("a", 5, 0.5), ("c", 9, 2.0)]
    names = "partial_query_text string, number_of_queries bigint, execution_minutes double"
    fragment = reports.shape_fragment(spark.createDataFrame(rows, names)).first()[0]
    assert fragment == (
        "<tr><td>c</td><td>9</td><td>2.0</td></tr>"
        "<tr><td>a</td><td>5</td><td>0.5</td></tr>"
        "<tr><td>b</td><td>5</td><td>1.0</td></tr>"
    )


# --- hot keys


def hot_rows(spark, n=9000):
    """A third of the rows have one key, some none."""
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100)
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("x"))


def key_side(spark):
    return spark.createDataFrame([(-1, "hot"), (None, "none"), *[(i, f"s{i}") for i in range(0, 100, 2)]], "k bigint, s string")


def test_a_hot_key_is_spread_and_no_other_is(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="16",
         spark__sql__autoBroadcastJoinThreshold="-1")
    rows, side = hot_rows(spark), key_side(spark)
    joined = join_hot_keys(rows, side, ["k"], ["x"], part_rows=100)
    assert sorted(joined.collect()) == sorted(rows.join(side, "k").collect())
    placed = joined.withColumn("task", F.spark_partition_id())
    where = placed.groupBy("k").agg(F.countDistinct("task").alias("tasks"), F.count("*").alias("n"))
    tasks = {r["k"]: (r["tasks"], r["n"]) for r in where.collect()}
    assert tasks.pop(-1)[0] >= 12
    # The other keys have some sixty rows and stay in one place each.
    assert all(found == 1 for found, _ in tasks.values())


def test_counts_of_the_caller_are_used(spark):
    rows, side = hot_rows(spark), key_side(spark)
    counts = key_counts(rows, ["k"]).withColumn("key_rows", F.lit(10**9))
    plain = sorted(rows.join(side, "k").collect())
    assert sorted(join_hot_keys(rows, side, ["k"], ["x"], 10**8, counts).collect()) == plain


# --- rollup


def rolled(spark, usage, metering, as_of, *days):
    frames = spark.createDataFrame(usage, USAGE), spark.createDataFrame(metering, METERING)
    with rollup.passing_rollup(spark) as name:
        for first, last in days:
            rollup.refresh(name, frames[0], at(first).date(), at(last).date())
        hours = rollup.hours_since(spark.table(name), at(as_of))
        shares = reports.shares_of_hours(hours, frames[1], at(as_of))
        return {(r[0], r[1]): float(r[2]) for r in shares.collect()}


def test_rollup_gives_the_same_report(spark):
    rng = Random(5)
    usage, metering = [], []
    for day in (9, 10, 11, 12):
        for hour in range(24):
            metering.append(meter_row(start=f"2024-01-{day:02d} {hour:02d}:00:00", credits=str(rng.randint(1, 9))))
            for _ in range(4):
                minute = rng.choice(["00:00", "00:00", "00:01", "30:00"])
                usage.append(
                    usage_row(f"u{rng.randrange(5)}", rng.choice(["A_WH", None]),
                              f"2024-01-{day:02d} {hour:02d}:{minute}", rng.choice([0, 7, 30]))
                )
    span = ("2024-01-09", "2024-01-12")
    for as_of in ("2024-02-10", "2024-02-10 05:00:00", "2024-02-11 23:00:00"):
        expected = credits_of(spark, usage, metering, as_of)
        assert expected and rolled(spark, usage, metering, as_of, span) == expected
        # Days written twice, and one by one, are the same.
        assert rolled(spark, usage, metering, as_of, span, ("2024-01-11", "2024-01-12")) == expected
    with pytest.raises(ValueError, match="full hours"):
        rolled(spark, usage, metering, "2024-02-10 05:30:00", span)


def test_a_corrected_day_replaces_the_old_one(spark):
    first = spark.createDataFrame([usage_row("a", time=5), usage_row("b", start="2024-01-16 10:00:00")], USAGE)
    second = spark.createDataFrame([usage_row("a", time=9)], USAGE)
    with rollup.passing_rollup(spark) as name:
        rollup.refresh(name, first, at("2024-01-15").date(), at("2024-01-16").date())
        rollup.refresh(name, second, at("2024-01-15").date(), at("2024-01-15").date())
        found = {(r["user_name"], r["user_time"]) for r in spark.table(name).collect()}
        assert found == {("a", 9), ("b", 100)}
        rollup.drop_days(spark, name, at("2024-01-16").date())
        assert spark.table(name).count() == 1


def test_the_report_reads_the_rollup_and_only_its_days(spark):
    usage = [usage_row(start=f"2024-01-{day:02d} 10:30:00") for day in range(1, 30)]
    with rollup.passing_rollup(spark) as name:
        rollup.refresh(name, spark.createDataFrame(usage, USAGE), at("2024-01-01").date(), at("2024-01-30").date())
        hours = rollup.hours_since(spark.table(name), at("2024-02-20"))
        plan = executed_plan(hours)
        assert plan.count("FileScan") == 1 and "usage_hours_" in plan
        assert re.search(r"PartitionFilters: \[[^]]*day[^]]*>= 2024-01-20", plan)
        assert hours.count() == 10
