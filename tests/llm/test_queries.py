"""The registered queries against their SQL, the pipeline against plain versions of its stages."""

from collections import defaultdict

import corpus_pipeline
import pytest
from compare import compare, duck_tables
from plain import near_duplicates as plain_near_duplicates
from pyspark.sql import functions as F

from creditloom.llm import mixing, quality
from creditloom.llm.queries import oracle_sql, queries
from creditloom.sources.shared import written

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    assert compare(queries()[name](spark, sf_dir), duck_tables(sf_dir), oracle_sql()[name]) is None


def test_names():
    assert set(oracle_sql()) < set(queries())
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries())
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-copy removal", "source mixture", "packing",
    ]


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = written(stages["quality classifier"](spark, docs, sf_dir))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {
        r["doc_id"] for r in quality.classified(docs, labels).where("predicted = 1").collect()
    }
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == good
    clean = kept.join(labels.where("quality = 1"), "doc_id").count()
    assert clean == docs.join(labels.where("quality = 1"), "doc_id").count()

    single = written(stages["near-copy removal"](spark, kept, sf_dir))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    groups = plain_near_duplicates(texts, 5, 80)
    assert single.columns == columns
    assert {r["doc_id"] for r in single.collect()} == set(groups.values())

    mixed = written(stages["source mixture"](spark, single, sf_dir))
    assert mixed.columns == columns
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in single.collect():
        sizes[r["source"]] += len(r["text"].split())
    for r in mixed.collect():
        taken[r["source"]] += len(r["text"].split())
    shares = mixing.targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    )
    assert all(abs(taken[r["source"]] - r["target"]) <= 1 for r in shares.collect())

    packed = stages["packing"](spark, mixed, sf_dir)
    assert packed.agg(F.sum("length")).first()[0] == (
        packed.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    )
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, packed.collect()))


def test_stages_on_odd_rows(spark, sf_dir):
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
        (None, "a b c", "en", "s", 5), (3, "word " * 100_000, None, "t", None), (4, "x", "en", "t", 1),
    ]
    odd = spark.createDataFrame(rows, DOCS).withColumn("row", F.lit(1)).withColumn("size", F.lit("x"))
    for docs in (odd, odd.limit(0)):
        docs = written(docs)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = written(stage(spark, docs, sf_dir))
            assert after.columns == docs.columns
            docs = after
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
