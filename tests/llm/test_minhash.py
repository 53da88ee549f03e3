import random

import numpy as np
import pytest
from plain import components as plain_components
from plain import near_duplicates as plain_near_duplicates
from plain import shingles
from pyspark.sql import functions as F

from creditloom.llm import minhash
from creditloom.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts):
    rows = [(i, text, "en", "s", len(text or "")) for i, text in texts]
    return spark.createDataFrame(rows, SCHEMA)


def found_components(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect()}


@pytest.mark.parametrize("k", [2, 5])
def test_equals_brute_force(spark, sf_dir, k):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = minhash.near_duplicates(docs, k, 80)
    assert found_components(found) == plain_near_duplicates(texts, k, 80)
    assert {r["doc_id"]: r["n_shingles"] for r in found.collect()} == {
        i: len(shingles(text, k)) for i, text in texts.items()
    }


def varied(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def test_groups_of_near_copies_and_of_almost_near_copies(spark, monkeypatch):
    """Groups whose members are near to some others only, in blocks smaller than the group."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(5)
    texts = []
    for changes in (1, 4, 7, 10, 14):
        base = [f"b{changes}-{i}" for i in range(100)]
        texts += [" ".join(varied(rng, base, changes)) for _ in range(40)]
    # A chain: each a little further from the first.
    chain = [f"c{i}" for i in range(100)]
    for step in range(30):
        chain = varied(rng, chain, 3)
        texts.append(" ".join(chain))
    texts += texts[:20]
    numbered = list(enumerate(texts))
    rng.shuffle(numbered)
    found = minhash.near_duplicates(docs_of(spark, numbered), 2, 80)
    assert found_components(found) == plain_near_duplicates(dict(numbered), 2, 80)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [
        (5, None), (6, ""), (7, " \n\t"), (1, "One"), (2, "one"), (3, "one two"), (4, "ONE\ttwo"),
        (8, long), (9, long + " more"), (None, "one two"), (None, None), (4, "one two"),
    ]
    docs = docs_of(spark, rows).withColumn("rep", F.lit("x")).withColumn("band", F.lit(1))
    found = minhash.near_duplicates(docs, 2, 80)
    rows = [tuple(r) for r in found.collect()]
    key = lambda row: (row[0] is None, row[0] or 0, row[1])
    assert sorted(rows, key=key) == [
        (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (4, 1, 3, False),
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 49_999, 8, True),
        (9, 50_000, 8, False), (None, 0, None, False), (None, 1, None, False),
    ]
    kept = minhash.without_copies(docs, 2, 80)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 3, 5, 6, 7, 8, None, None]


def test_one_row_of_each_group_stays(spark):
    rows = [
        (1, "a b c"), (1, "a b c"), (2, "a b c"), (3, "d e f"), (3, "a b c"), (3, "g h i"), (4, "g h i"),
        (5, ""), (5, ""), (None, "a b c"), (None, "a b c"),
    ]
    kept = minhash.without_copies(docs_of(spark, rows), 2, 80)
    found = sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect())
    assert found == [
        (0, "a b c"), (0, "a b c"), (1, "a b c"), (3, "d e f"), (3, "g h i"), (5, ""), (5, ""),
    ]


def test_empty_table(spark):
    assert minhash.near_duplicates(docs_of(spark, []), 2, 80).count() == 0
    assert minhash.without_copies(docs_of(spark, [])).count() == 0


def test_sketches_estimate_and_are_full():
    rng = np.random.default_rng(1)
    size = 125
    for n in (1, 3, 40, 4000):
        elements = rng.integers(0, 2**63, n).astype(np.uint64)
        part = elements[: max(1, (3 * n) // 4)]
        place = np.repeat([0, 1], [n, len(part)])
        full = minhash.sketch(place, np.concatenate([elements, part]), 2, size)
        assert (full != np.uint64(2**64 - 1)).all()
        agree = (full[0] == full[1]).mean()
        assert abs(agree - len(part) / n) < 0.2


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    links += [(i, i + 1) for i in range(300, 360)] + [(400, i) for i in range(401, 440)]
    frame = spark.createDataFrame([*links, (None, 3), (5, None)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(frame, "a", "b").collect()}
    ends = {i for a, b in links if a != b for i in (a, b)}
    expected = plain_components(ends, [link for link in links if link[0] != link[1]])
    assert found == expected


def test_bands_by_threshold():
    assert minhash.plan_bands(80) == (25, 5)
    for percent in range(5, 101):
        bands, rows = minhash.plan_bands(percent)
        p = min(percent, 99) / 100
        assert (1 - p**rows) ** bands <= minhash.MISS * 1.0001
        assert bands * rows <= minhash.SIZE or rows == 1
    for bad in (0, 101, -5):
        with pytest.raises(ValueError):
            minhash.plan_bands(bad)


@pytest.mark.parametrize("percent", [50, 65, 92])
def test_other_thresholds_lose_no_link(spark, percent):
    some = random.Random(percent)
    texts = {}
    for group in range(60):
        words = [f"g{group}w{i}" for i in range(40)]
        for copy in range(4):
            changed = [w if some.random() > 0.18 else f"x{some.randint(0, 9**9)}" for w in words]
            texts[group * 4 + copy] = " ".join(changed if copy else words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = found_components(minhash.near_duplicates(frame, k=1, percent=percent))
    assert found == plain_near_duplicates(texts, 1, percent)
