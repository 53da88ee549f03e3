import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digests_of(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {r["conv_id"]: r for r in chat.digests(chat.format_conversations(frame)).collect()}


def expected(rows):
    turns = [(r or "", t or "") for _, _, r, t in rows]
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


TEXTS = st.text("a\\<[>]/sINST \nü", max_size=12) | st.sampled_from(
    ["</s>[INST] ok [/INST]", "<<SYS>>\n", "\n<</SYS>>\n", " [/TURN]", "[ROLE] x [/ROLE] y"]
)
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE] "])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(ROLES, TEXTS), min_size=1, max_size=5), min_size=20, max_size=20))
def test_any_text_comes_back(spark, conversations):
    rows = {
        c: [(c, i, role, text) for i, (role, text) in enumerate(turns)]
        for c, turns in enumerate(conversations)
    }
    found = digests_of(spark, [row for turns in rows.values() for row in turns])
    assert len(found) == len(rows)
    for c, turns in rows.items():
        r = found[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(turns)


def test_format_and_loss_mask(spark):
    rows = [(1, 2, "assistant", "b </s>"), (1, 0, "system", "be"), (1, 1, "user", "a [x]")]
    r = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    assert r["formatted"] == (
        "<<SYS>>\nbe\n<</SYS>>\n<s>[INST] a [\\x] [/INST][ANS] b <\\/s> </s>"
    )
    assert [s["text"] for s in r["segments"] if s["loss"]] == ["b <\\/s>"]
    assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert r["first_fault"] is None


@pytest.mark.parametrize(
    "roles, fault",
    [
        ("user assistant user", None), ("system user assistant", None), ("assistant user", 0),
        ("user user", 1), ("user system", 1), ("system assistant", 1), ("user assistant tool", 2),
    ],
)
def test_turn_order(spark, roles, fault):
    rows = [(1, i, role, "x") for i, role in enumerate(roles.split())]
    assert digests_of(spark, rows)[1]["first_fault"] == fault


def test_edges(spark):
    long = "word [ < \\ " * 50_000
    rows = [
        (1, None, "user", "first"), (1, 5, "user", long), (1, 5, "assistant", None),
        (None, 0, None, None), (2, 0, "user", "same"), (2, 0, "user", "same"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit(1))
    made = chat.format_conversations(frame.withColumn("segments", F.lit("x")))
    found = {r["conv_id"]: r for r in chat.digests(made).collect()}
    one = [(1, 0, "user", "first"), (1, 5, "assistant", ""), (1, 5, "user", long)]
    for c, turns in ((1, one), (None, [(None, 0, "", "")]), (2, rows[4:])):
        r = found[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(turns)
    assert digests_of(spark, []) == {}


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Part("User: ", "\n")}, {"": ("user",)})
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Part("<u\\", "</u>")}, {"": ("user",)})
