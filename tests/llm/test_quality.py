import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import quality

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def area_under_curve(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    for value in np.unique(scores):
        same = scores[order] == value
        ranks[order[same]] = np.flatnonzero(same).mean() + 1
    good = labels == 1
    n, m = good.sum(), (~good).sum()
    return (ranks[good].sum() - n * (n + 1) / 2) / (n * m)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = quality.classified(docs, labels).join(labels, "doc_id").toPandas()
    assert all(
        held == (zlib.crc32(str(i).encode()) % 5 == 0)
        for i, held in zip(found["doc_id"], found["held_out"])
    )
    held = found[found["held_out"]]
    scores, truth = held["score"].to_numpy(), held["quality"].to_numpy()
    assert len(held) > 500 and area_under_curve(scores, truth) > 0.97
    assert (held["predicted"] == truth).mean() > 0.95
    assert (held["predicted"][truth == 1]).mean() > 0.98
    assert ((found["score"] >= 0.3) == (found["predicted"] == 1)).all()
    assert found["score"].between(0, 1).all()


def test_training_ignores_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = F.when(quality.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    one = quality.trained(docs, labels)
    assert one == quality.trained(docs.repartition(5), labels.withColumn("quality", turned))
    assert one.rules


def test_column_equals_the_model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = [f"s_{name}" for name in quality.NAMES]
    rows = quality.with_statistics(docs, "doc_id").select(
        *names, model.column().alias("score")
    ).toPandas()
    assert rows["score"].to_numpy() == pytest.approx(model.score(rows[names].to_numpy()))


def test_statistics(spark):
    text = "One two, two!\n\tX1 | y.\nOne two, two!"
    frame = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in quality.with_statistics(frame, "doc_id").collect()}
    one = rows[1]
    assert one["s_words"] == pytest.approx(np.log1p(9)) and one["s_distinct_words"] == 6 / 9
    assert one["s_distinct_lines"] == 2 / 3 and one["s_bars"] == 1 / 9
    assert one["s_exclamations"] == 2 / 9 and one["s_commas"] == 2 / 9 and one["s_stops"] == 1 / 9
    assert one["s_capitals"] == 3 / len(text) and one["s_digits"] == 1 / len(text)
    assert one["s_symbols"] == 3 / 9
    assert rows[2][1:] == rows[3][1:] and rows[2]["s_words"] == 0


def test_lasso_drops_rules_that_say_nothing():
    rng = np.random.default_rng(0)
    z = rng.integers(0, 2, (2000, 30)).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * z[:, 0] - 2 * z[:, 1])))).astype(float)
    _, weights = quality.lasso_logistic(z, y, penalty=0.2)
    assert weights[0] > 1 and weights[1] < -0.5 and (np.abs(weights[2:]) < 0.1).all()
    assert (weights == 0).sum() > 20


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 200_000), (None, "x y"), (2, "again"), (7, "a b")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    docs = docs.withColumn("score", F.lit(2.0)).withColumn("s_words", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 0), (7, None, 0), (7, 0, 1), (None, 1, 0)], LABELS)
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        found = quality.classified(docs, known).collect()
        assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    model = quality.trained(docs, labels)
    kept = quality.accepted(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert quality.accepted(docs, model, threshold=1.1).count() == 0
    assert quality.classified(docs.limit(0), labels).count() == 0
