import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import failing_once
from pyspark.sql import functions as F

from creditloom.llm import phrases as P

SCHEMA = "doc_id bigint, text string, lang string"
NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(rows, least=10, share=50, top=2000):
    counts = {}
    for _, text, lang in rows:
        count = counts.setdefault("und" if lang is None else lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            found = re.findall("[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                count.update(zip(*[found[i:] for i in range(size)]))
    result = []
    for lang, count in counts.items():
        n = sum(c for p, c in count.items() if len(p) == 1)
        known = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        listed = []
        for p, a in known.items():
            longer = [c for q, c in known.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if any(100 * c >= share * a for c in longer):
                continue
            score, k = min(
                (10**6 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))
            )
            listed.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


def found(docs, **options):
    return sorted(tuple(r) for r in P.collocations(docs, **options).select(*NAMES).collect())


def random_rows(seed, n=300):
    some = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "x\x00", "日本", "a-b", " ", "_", "c", "d"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!"]
    rows = []
    for i in range(n):
        words = [some.choice(vocabulary) + some.choice(ends) for _ in range(some.randint(0, 40))]
        text = some.choice([None, "", "".join(words), "".join(words), "of the c " * 3])
        rows.append((i, text, some.choice(["en", "fr", None, "und", "en\nx", ""])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_plain_version(spark, seed):
    rows = random_rows(seed)
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_many_small_tries(spark, monkeypatch):
    for name, value in (("TRIE", 7), ("TRIES_AT_ONCE", 2), ("TRIALS", 1), ("TRIED", 2), ("PART_BYTES", 500)):
        monkeypatch.setattr(P, name, value)
    rows = random_rows(5)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(docs, least=4, share=80, top=30) == plain(rows, 4, 80, 30)


def test_full_tables_of_bits_lose_nothing(spark, monkeypatch):
    """With tables in which nearly every bit is set all phrases are candidates."""
    monkeypatch.setattr(P, "WORD_BITS", 15)
    monkeypatch.setattr(P, "PHRASE_BITS", 15)
    monkeypatch.setattr(P, "has_bit", lambda table, hashes: np.ones(len(hashes), bool))
    rows = random_rows(6, 60)
    assert found(spark.createDataFrame(rows, SCHEMA), least=3) == plain(rows, 3)


def test_large_counts_are_exact(spark):
    a, first, rest = 3_037_000_501, 3_037_000_507, 3_037_000_511
    row = spark.range(1).select(
        P.score_of(F.lit(a), F.lit(first), F.lit(rest)).alias("score")
    )
    assert row.first()[0] == 10**6 * a * a // (first * rest)


def test_odd_tables(spark):
    rows = [(None, "a b " * 10, None), (1, "a b " * 10, "und"), (1, "a b " * 10, "und"), (2, None, "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.withColumns({n: F.lit("x") for n in ("n", "word", "hash", "w1", "shard", "place")})
    assert found(clashing) == plain(rows)
    assert found(docs.limit(0)) == [] and found(docs.where("doc_id = 2")) == []
    long = [(1, "p q r. " * 50_000, "en"), (2, " ".join(f"w{i}" for i in range(50_000)), "en")]
    assert found(spark.createDataFrame(long, SCHEMA)) == plain(long)


def test_lost_task(spark):
    rows = random_rows(8)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(failing_once(docs, 1)) == plain(rows)


def test_hot_phrase(spark):
    rows = [(i, "hot word pair" if i % 3 == 0 else f"hot word{i % 7} x", "en") for i in range(3000)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_double_array():
    some = random.Random(1)
    pairs = sorted({(some.randint(0, 60), min(int(some.expovariate(0.05)), 199)) for _ in range(3000)})
    array = P.DoubleArray(200)
    roots = np.unique([a for a, _ in pairs])
    states = array.add(np.zeros(len(roots), np.int64), roots)
    state_of = dict(zip(roots.tolist(), states.tolist()))
    edges = sorted((state_of[a], b) for a, b in pairs)
    reached = array.add(np.array([s for s, _ in edges]), np.array([b for _, b in edges]))
    assert len(set(reached.tolist()) | set(states.tolist()) | {0}) == len(reached) + len(states) + 1
    trie = P.Trie(pa.array([], pa.large_string()), array.base, array.check, np.zeros(0), 0, 200)
    for s in sorted(set(states.tolist())):
        to = trie.move(np.full(200, s), np.arange(200))
        assert {b for b in range(200) if to[b] >= 0} == {b for t, b in edges if t == s}


def test_a_trie_takes_memory_by_its_phrases():
    """Hot first words with thousands of followers, and a long tail of rare words."""
    some = random.Random(2)
    tail = [f"word{i}" for i in range(20_000)]
    pairs = {(some.choice(["the", "of", "in"]), some.choice(tail)) for _ in range(15_000)}
    pairs |= {(some.choice(tail), some.choice(tail)) for _ in range(30_000)}
    pairs |= {(some.choice(tail), "the") for _ in range(10_000)}
    w1, w2 = (pa.array(words) for words in zip(*sorted(pairs)))
    trie = P.build_trie([w1, w2, pa.nulls(len(w1), pa.string())], pa.array(["en"] * len(w1)))
    assert len(trie.base) < 24 * len(w1)
    text = " . ".join(f"{a} {b}" for a, b in zip(w1.to_pylist(), w2.to_pylist()))
    assert (trie.counts(P.words_of("en", pa.array([text]))) == 1).all()
    assert not trie.counts(P.words_of("fr", pa.array([text]))).any()


def shuffled_bytes(spark):
    """Bytes of all shuffles that this session's disk holds."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = list(manager.localDirsString())
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("shuffle_*.data"))


def test_hashes_take_few_bytes_of_a_shuffle(spark):
    """Pairs of random words, nearly all different, take less than five bytes each."""
    some = random.Random(3)
    rows = [(i, " ".join(f"w{some.randrange(30_000)}" for _ in range(3000)), "en") for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    every = spark.sparkContext.broadcast(b"\xff" * (1 << 12))
    pairs = len({pair for _, text, _ in rows for pair in zip(text.split(), text.split()[1:])})
    before = shuffled_bytes(spark)
    assert any(P.frequent_bits(docs, 2, 600_000, every))
    assert 0 < shuffled_bytes(spark) - before < 5 * pairs


@pytest.mark.parametrize("least", [2, 10, 300])
def test_blocks_of_hashes(spark, monkeypatch, least):
    """Many buckets, and a task that sends its hashes bit by bit."""
    for name, value in (("HELD", 5), ("BUCKET_WORDS", 3), ("PART_BYTES", 300)):
        monkeypatch.setattr(P, name, value)
    rows = random_rows(9) + [(i, "of the d " * 4, "en") for i in range(100)]
    assert found(spark.createDataFrame(rows, SCHEMA), least=least) == plain(rows, least)
    some = np.random.default_rng(4)
    hashes = np.append(some.integers(0, 1 << 40, 5000, np.uint64), np.uint64((1 << 40) - 1))
    hashes, n = P.summed(np.append(hashes, hashes[:9]), np.full(5010, least - 1), least)
    sent = P.blocks(hashes, n, 7).to_pydict()
    assert sent["bucket"] == list(range(128))
    assert (np.concatenate([P.hashes_of(steps) for steps in sent["steps"]]) == hashes).all()
    counts = np.frombuffer(b"".join(sent["n"]), np.min_scalar_type(least))
    assert (counts == least).sum() == 9 and (counts >= least - 1).all()


def test_many_candidates_need_no_further_reading_of_the_texts(spark, monkeypatch):
    """However many tries the candidates fill, texts are read as often as with one."""

    def readings(tries_at_once, seed):
        monkeypatch.setattr(P, "TRIES_AT_ONCE", tries_at_once)
        rows = random_rows(seed)
        read = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert found(docs.mapInArrow(counted, docs.schema), least=3) == plain(rows, 3)
        return read.value / len(rows)

    monkeypatch.setattr(P, "TRIE", 7)
    # Words, pairs, triples, candidates and one reading for all that is counted.
    assert readings(1, 11) <= 5
    assert readings(1000, 11) == 5


def test_dealt_phrases(spark, monkeypatch):
    """Many buckets, of which some have no frequent phrase, several langs, and a task that is lost."""
    for name, value in (("TRIES_AT_ONCE", 0), ("DEALT_WORDS", 40), ("PLACES", 64), ("PART_BYTES", 700)):
        monkeypatch.setattr(P, name, value)
    rows = random_rows(12) + [(i, "rare%d word. " % i * 2 + "hot word pair " * 300, "en") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(failing_once(docs, 2)) == plain(rows)
    assert found(docs, least=2, share=70) == plain(rows, 2, 70)
    assert found(docs.limit(0)) == [] and found(docs, least=10**6) == []


def test_lines_of_a_part():
    part = P.words_of("en", pa.array(["the cat sat. the cat ran é x\x00 the cat", None, "日本 the cat"]))
    every = b"\xff" * (1 << 12)
    kept = list(P.phrases_of(part, every, every))
    sent = pa.Table.from_batches([P.lines_of(part, kept, 3)])
    assert 1 < sent.num_rows <= 3 and set(sent["lang"].to_pylist()) == {"en"}
    lines = P.read_lines("en", sent)
    words = lines.words.distinct.to_pylist()
    counts = {tuple(words[c] for c in p if c >= 0): n for *p, n in zip(*lines.codes, lines.n.tolist())}
    assert counts["the", "cat"] == 4 and counts["é", "x\x00", "the"] == 1 and ("sat", "the") not in counts
    assert sum(counts.values()) == sum(int(p.n.sum()) for p in kept) and len(counts) == len(lines.n)
    assert set(lines.hashes().tolist()) == {h for p in kept for h in p.hashes.tolist()}
    large = np.array([1, 255, 256, 1 << 31])
    assert (P.counts_of(P.planes(large)) == large).all()
