import hashlib
import zlib
from collections import defaultdict

import pytest
from compare import compare, duck_tables
from conftest import failing_once

from creditloom.llm import conversation_trie as T
from creditloom.llm.queries import TRIE_SQL

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The nodes of the trie by dictionaries of prefixes."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        whole = turns.get(c - c % 20, [])[:h] + turns[c][h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    nodes = {}
    for node in sorted(members, key=len, reverse=True):
        kids = [k for k in nodes if len(k) == len(node) + 1 and k[:-1] == node]
        words = len(node[-1][1].split()) if node else 0
        nodes[node] = {
            "conv_id": members[node][0],
            "depth": len(node),
            "parent_conv_id": members[node[:-1]][0] if node else None,
            "n_convs": len(members[node]),
            "n_children": len(kids),
            "n_leaves": sum(nodes[k]["n_leaves"] for k in kids) or 1,
            "saved_tokens": (len(members[node]) - 1) * words
            + sum(nodes[k]["saved_tokens"] for k in kids),
            "ends_sha256": hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        }
    return sorted(tuple(n[name] for name in T.NODE) for n in nodes.values())


def found(spark, rows):
    trie = T.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in trie.select(*T.NODE).collect()), key=lambda r: (r[0], r[1]))


def random_rows(seed, convs, hot):
    import random

    some = random.Random(seed)
    rows = []
    for c in range(convs):
        length = some.choice([0, 1, 2, 3, 5, 9])
        texts = ["hello there"] * 4 if some.random() < hot else []
        while len(texts) < length:
            texts.append(some.choice(["a", "b b", "c c c", None, ""]))
        for turn, text in enumerate(texts):
            rows.append((c, turn, some.choice(["user", "user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_small_blocks(spark, monkeypatch, seed):
    """Blocks of a few paths, so that nearly every node reaches over a boundary, on several levels."""
    monkeypatch.setattr(T, "BLOCK_PATHS", 5)
    monkeypatch.setattr(T, "BLOCK_ENTRIES", 20)
    monkeypatch.setattr(T, "LEAST_PATHS", 3)
    rows = random_rows(seed, 150, 0.4)
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "x y"), (0, 1, "user", "x y"), (0, 1, "assistant", "z"),
        (3, 0, "user", "only"), (None, 0, "user", "lost"), (25, 7, "", ""), (40, 0, "user", "w " * 30_000),
        (41, 0, "user", "w " * 30_000), (42, 2, "user", "w"), (42, 2, "user", "w"), (43, 0, "a", ":b"),
        (44, 0, "a:", "b"),
    ]
    assert found(spark, rows) == plain(rows)


def test_no_turns_left(spark):
    """Conversation 3 has no group opening and h = 0 or more; one that loses all turns is in the root."""
    alone = [c for c in range(21, 60) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "gone") for c in alone]
    assert found(spark, rows) == plain(rows)
    (root,) = found(spark, rows)
    assert root[:5] == (alone[0], 0, None, 2, 0)


def test_hot_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 6000) for t in range(2)]
    assert found(spark, rows) == plain(rows)


def test_empty_table_and_other_columns(spark, sf_dir):
    from pyspark.sql import functions as F

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    clashing = turns.withColumns({n: F.lit("x") for n in ("path", "n", "depth", "entries", "place", "h")})
    assert T.prefix_trie(turns.limit(0)).collect() == []
    assert compare(T.prefix_trie(clashing), duck_tables(sf_dir), TRIE_SQL) is None


def test_lost_task(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").repartition(4)
    lost = T.prefix_trie(failing_once(turns, 2))
    assert compare(lost, duck_tables(sf_dir), TRIE_SQL) is None
