"""Every registered query against its SQL on the same tables."""

import pytest
from compare import compare, duck_tables

from creditloom.sources.views import TABLES

import __spark_entry__ as entry_module

ORACLE = entry_module.oracle_sql()
CORPUS = entry_module.corpus_queries()
QUERIES = {name: plan for name, plan in entry_module.queries().items() if name not in CORPUS}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_tables(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) - set(CORPUS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    QUERIES[name](spark, empty_dir).collect()


def test_the_time_zone_is_put_back(spark, sf_dir, conf):
    conf(spark__sql__session__timeZone="Asia/Tokyo")
    daily = QUERIES["daily_credits"](spark, sf_dir)
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    sql = ORACLE["daily_credits"]
    assert compare(daily, duck_tables(sf_dir), sql) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
