"""The error output of runs, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("executionId", T.StringType()),
        T.StructField("sourceFile", T.StringType()),
        T.StructField("errorReason", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def read_error_lines(spark: SparkSession, path: str) -> DataFrame:
    """Error records of all runs and files; their folders give ``execution_id`` and ``feed_file``."""
    return spark.read.schema(ERROR_SCHEMA).json(path)
