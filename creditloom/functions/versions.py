"""A Python function for SQL: the library versions on the workers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register_versions(spark: SparkSession, name: str = "compute") -> None:
    """Make ``name()`` callable from SQL; it returns ``[numpy version, pandas version]``."""

    @F.udf(T.ArrayType(T.StringType()))
    def versions():
        import numpy
        import pandas

        return [numpy.__version__, pandas.__version__]

    spark.udf.register(name, versions)
