import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditloom.llm import token_counts as T

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def merges():
    return T.read_merges(PATH)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [
        len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)
    ]


def counts(texts, merges):
    return T.counts_of(pa.array(texts, pa.string()), merges, regex.compile(T.PATTERN)).tolist()


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = T.token_counts(docs, PATH).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    expected = library(list(texts.values()))
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == dict(zip(texts, expected))
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) for r in rows)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


def test_random_texts(merges, library):
    some = random.Random(3)
    signs = [
        lambda: chr(some.randint(32, 126)),
        lambda: chr(some.randint(0, 0x2FFF)),
        lambda: some.choice(" \n\t\x85  'sdt"),
        lambda: chr(some.randint(0x4E00, 0x9FFF)),
        lambda: chr(some.randint(0x10000, 0x1FFFF)),
        lambda: "<|endoftext|>",
    ]
    texts = ["".join(some.choice(signs)() for _ in range(some.randint(0, 40))) for _ in range(4000)]
    assert counts(texts, merges) == library(texts)


def test_all_code_points_split_alike():
    split, pattern = Tokenizer.from_file(PATH).pre_tokenizer, regex.compile(T.PATTERN)
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(signs), 4096):
        text = "".join(f"a{c}a1{c}1.{c}. {c}  " for c in signs[start : start + 4096])
        expected = [span for _, span in split.pre_tokenize_str(text)]
        assert [found.span() for found in pattern.finditer(text)] == expected


def test_overlapping_and_long(merges, library):
    long = "".join(random.Random(5).choice("abcdef") for _ in range(20_000))
    texts = ["a" * n for n in range(70)] + [long, long.upper() + " " * 999, "word " * 50_000]
    assert counts(texts, merges) == library(texts)


def test_added_tokens(merges):
    texts = ["<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext", " <|endoftext|> "]
    assert counts(texts, merges)[:2] == [1, 4]
    assert counts(texts, merges)[3] == 3


def naive(symbols, ranks):
    while True:
        pairs = [(ranks.get(pair, 1 << 40), i) for i, pair in enumerate(zip(symbols, symbols[1:]))]
        if not pairs or min(pairs)[0] == 1 << 40:
            return len(symbols)
        _, i = min(pairs)
        symbols = symbols[:i] + [symbols[i] + symbols[i + 1]] + symbols[i + 2 :]


def small_file(tmp_path, pairs, **model):
    signs = T.byte_symbols()
    vocab = {sign: i for i, sign in enumerate(signs)}
    for a, b in pairs:
        vocab.setdefault(a + b, len(vocab))
    found = {
        "model": {"type": "BPE", "vocab": vocab, "merges": [f"{a} {b}" for a, b in pairs], **model},
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False},
    }
    file = tmp_path / "small.json"
    file.write_text(json.dumps(found))
    return str(file)


def test_one_merge_at_a_time_gives_the_same(tmp_path):
    pairs = [("a", "a"), ("b", "a"), ("aa", "b"), ("aa", "aa"), ("ba", "ba"), ("aab", "a")]
    merges = T.read_merges(small_file(tmp_path, pairs))
    ranks = {pair: i for i, pair in enumerate(pairs)}
    some = random.Random(7)
    texts = ["".join(some.choice("aab") for _ in range(some.randint(1, 30))) for _ in range(500)]
    found = T.surviving_symbols(pa.array(texts), merges)
    assert found.tolist() == [naive(list(text), ranks) for text in texts]


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="before those of their parts"):
        T.read_merges(small_file(tmp_path, [("ab", "c"), ("a", "b")]))
    with pytest.raises(ValueError, match="no plain"):
        T.read_merges(small_file(tmp_path, [("a", "b")], dropout=0.1))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "é"), (3, "é")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs = docs.withColumn("n_tokens", F.lit("x")).withColumn("counts", F.lit(1))
    found = sorted(map(tuple, T.token_counts(docs, PATH).collect()), key=str)
    assert found == sorted(
        [(1, 0, 0, False), (2, 0, 0, False), (2, 0, 0, False), (None, 3, 2, False),
         (3, 2, 1, False), (3, 2, 1, False)], key=str,
    )
    empty = T.token_counts(docs.limit(0), PATH)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert T.token_counts(docs, PATH, limit=1).where("over_limit").count() == 1


def test_sequences_without_merges(merges):
    assert T.surviving_symbols(pa.array([], pa.string()), merges).tolist() == []
    assert T.surviving_symbols(pa.array(["", "\x01"]), merges).tolist() == [0, 1]
    assert np.array_equal(T.surviving_symbols(pa.array(["x", "the", "the"])[1:], merges), [1, 1])
