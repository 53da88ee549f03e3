"""Every job loses a task after it has read its rows; results stay the same."""

import pytest
from conftest import failing_once
from pyspark.sql import functions as F

from creditloom.llm import (
    chat,
    embed_dedup,
    licenses,
    minhash,
    mixing,
    neighbours,
    packing,
    page_text,
    quality,
    warc,
)
from creditloom.llm.queries import vocabulary


def warc_round_trip(spark, pages, tmp_path):
    folder = f"{tmp_path}/{pages.count()}-{id(pages)}"
    warc.write_archive(pages, folder)
    # Record names depend on the partitions.
    return warc.read_archive(spark, folder).drop("record_id")


OPERATORS = {
    "op1": ("documents", lambda s, df, p: licenses.scan(df)),
    "op2": ("embeddings", lambda s, df, p: embed_dedup.near_duplicates(df)),
    "op3": ("pages", lambda s, df, p: page_text.extract(df)),
    "op4": ("documents", lambda s, df, p: mixing.taken_words(df)),
    "op5": ("embeddings", lambda s, df, p: neighbours.nearest(df, F.col("vec_id") % 20 == 0)),
    "op6": ("conversations", lambda s, df, p: chat.digests(chat.format_conversations(df))),
    "op7": ("documents", lambda s, df, p: quality.classified(df, s.read.parquet(p))),
    "op8": ("documents", lambda s, df, p: packing.pack(df, **vocabulary())),
    "op9": ("documents", lambda s, df, p: minhash.near_duplicates(df, 2, 80)),
    "op10": ("pages", warc_round_trip),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_lost_task_changes_nothing(spark, sf_dir, tmp_path, name):
    table, operator = OPERATORS[name]
    path = tmp_path if name == "op10" else f"{sf_dir}/labels.parquet"
    whole = spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(4)
    expected = sorted(map(str, operator(spark, whole, path).collect()))
    lossy = failing_once(whole, 2)
    assert sorted(map(str, operator(spark, lossy, path).collect())) == expected
