"""The corpus pipeline: quality, near copies, source mixture, packing.

Each stage takes all documents that the one before it kept. The first three return the columns of
documents, the last the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import minhash, mixing, packing, quality
from creditloom.llm.queries import table, vocabulary
from creditloom.sources.shared import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of those given."""
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, threshold=0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return minhash.without_copies(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or cut to their target weights."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), scale=1.5, most=2)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in sequences of 1024 tokens."""
    return packing.pack(docs, **vocabulary())


STAGES = [
    ("quality classifier", keep_good),
    ("near-copy removal", drop_near_copies),
    ("source mixture", mix_sources),
    ("packing", pack_sequences),
]

# A classifier, components and tokens have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
