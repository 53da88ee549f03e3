from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from creditloom.llm import mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights=(3, 1, 2), scale=1.5, most=2):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_sources, found = scale * sum(sizes.values()), set(names), {}
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        above = {s for s in open_sources if weight[s] * unit >= most * sizes[s]}
        if not above:
            found |= {s: weight[s] * unit for s in open_sources}
            break
        for s in above:
            found[s] = most * sizes[s]
            left -= found[s]
        open_sources -= above
    return found


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100, "d": 1000, None: 7},
        {"a": 5},
        {"a": 0, "b": 3, "c": 900},
        {"x": 1, "y": 1, "z": 1},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def corpus():
    rows = []
    for i in range(600):
        source = ["a", "a", "a", "b", "c", None, "tiny"][i % 7 if i % 7 < 6 or i < 8 else 0]
        rows.append((i, " ".join(["w"] * (i * 37 % 300)), source))
    return rows


def test_words_taken(spark):
    rows = corpus()
    docs = docs_of(spark, rows)
    found = mixing.taken_words(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    targets = plain_targets(sizes)
    taken = defaultdict(int)
    source_of = {i: s for i, _, s in rows}
    for r in found:
        assert r["size"] == len(rows[r["doc_id"]][1].split())
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[source_of[r["doc_id"]]]
        taken[source_of[r["doc_id"]]] += r["taken"]
    assert len(found) == len(rows)
    assert all(abs(taken[s] - targets[s]) < 1 for s in targets)
    again = mixing.taken_words(docs.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_schedule_is_even_and_takes_each_word_once(spark):
    docs = docs_of(spark, corpus())
    pieces = mixing.mix(docs).where("slot IS NOT NULL").collect()
    spans = defaultdict(list)
    by_slot = defaultdict(lambda: defaultdict(int))
    for r in pieces:
        spans[r["doc_id"], r["pass"]].append((r["start"], r["taken"]))
        by_slot[r["slot"]][r["source"]] += r["taken"]
    for parts in spans.values():
        at = 0
        for start, taken in sorted(parts):
            assert start == at
            at += taken
    # Every eighth of the schedule has each source near its share.
    slots = sorted(by_slot)
    total = defaultdict(int)
    for counts in by_slot.values():
        for source, n in counts.items():
            total[source] += n
    words = sum(total.values())
    for part in range(8):
        some = slots[part * len(slots) // 8 : (part + 1) * len(slots) // 8]
        for source in total:
            share = sum(by_slot[s][source] for s in some) / sum(
                n for s in some for n in by_slot[s].values()
            )
            assert abs(share - total[source] / words) < 0.02


def test_edges(spark):
    rows = [
        (1, "a b", "s"), (1, "a b", "s"), (2, None, "s"), (2, None, "s"), (None, "c d e", "s"),
        (3, "", None), (4, "x" * 100_000 + " y", None), (5, "q", "t"),
    ]
    docs = docs_of(spark, rows)
    for name in ("size", "taken", "slot", "line", "target", "words", "pass", "row", "mark"):
        docs = docs.withColumn(name, F.lit(-1))
    found = mixing.taken_words(docs).select("doc_id", "size", "source_size").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=key) == [
        (1, 2, 7), (1, 2, 7), (2, 0, 7), (2, 0, 7), (3, 0, 2), (4, 2, 2), (5, 1, 1), (None, 3, 7),
    ]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == sum(
        r["taken"] for r in mixing.taken_words(docs).collect()
    )


def test_empty_table(spark):
    assert mixing.taken_words(docs_of(spark, [])).count() == 0
    assert mixing.mixed_documents(docs_of(spark, [])).count() == 0
    assert mixing.taken_words(docs_of(spark, [(1, "", "s")])).collect()[0]["taken"] == 0


def test_mixed_documents_repeat_and_cut(spark):
    docs = docs_of(spark, corpus())
    expected = {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs).collect()}
    counted = defaultdict(int)
    texts = {i: t for i, t, _ in corpus()}
    for r in mixing.mixed_documents(docs).collect():
        counted[r["doc_id"]] += len(r["text"].split())
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert dict(counted) == {i: n for i, n in expected.items() if n}


def test_the_first_slots_hold_every_source_at_its_rate(spark, sf_dir):
    """Any first part of the schedule mixes the sources as the whole does; a line of sources would not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs, weights=(3, 1, 2), scale=1.5, most=2).where("slot IS NOT NULL")
    taken = rows.groupBy("slot", "source").agg(F.sum("taken").alias("taken")).collect()
    whole, last = defaultdict(int), max(r["slot"] for r in taken)
    for r in taken:
        whole[r["source"]] += r["taken"]
    total = sum(whole.values())
    for part in (8, 16, 64, 256):
        first = defaultdict(int)
        for r in taken:
            if r["slot"] <= last // part:
                first[r["source"]] += r["taken"]
        words = sum(first.values())
        assert words > 0
        for source, all_words in whole.items():
            assert abs(first[source] / words - all_words / total) < 0.02 + part / last * 4


def test_the_first_slot_of_a_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = mixing.taken_words(docs).collect()
    taken = {r["doc_id"]: r["first_slot"] for r in found if r["first_slot"] is not None}
    assert all((r["first_slot"] is not None) == (min(r["size"], r["taken"]) > 0) for r in found)
    pieces = mixing.mix(docs).where("slot IS NOT NULL AND pass = 0 AND start = 0").collect()
    assert {r["doc_id"]: r["slot"] for r in pieces} == taken
