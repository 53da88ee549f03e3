"""Tables in the folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder under ``spark.checkpoint.dir``, or else under the warehouse.

    Whoever writes there owns the folder; what the package writes for its own use it checkpoints or
    keeps in a table that it drops.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        master = spark.conf.get("spark.master", "")
        local = master.startswith("local") and not master.startswith("local-cluster")
        if not base or (base.startswith(("file:", "/")) and not local):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/creditloom-{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the checkpoint folder.

    Every reader and every retried task sees the same rows in the same places, whichever executors
    are lost. With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes the files once
    the frame is out of use. A session without a checkpoint folder gets one in the warehouse.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def written(df: DataFrame, purpose: str = "rows") -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for rows of which readers need few columns."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
