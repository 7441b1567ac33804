"""Error records, their text form, counts and the first few per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def error_records(
    errors: DataFrame, run_id: str, at: Column | None = None, with_position: bool = False
) -> DataFrame:
    """The four fields of an error record, and with ``with_position`` where the row stood.

    The row itself is not kept: it may hold values that must not be stored in the clear.
    """
    moment = F.current_timestamp() if at is None else at
    position = ["_at"] if with_position else []
    return errors.select(
        F.lit(run_id).alias("execution_id"),
        F.col("_source_file").alias("source_file"),
        F.coalesce("_reason", F.lit("unknown error")).alias("error_reason"),
        moment.alias("timestamp"),
        *position,
    )


def error_lines(records: DataFrame) -> DataFrame:
    """One JSON text per error record, always a single line."""
    line = F.to_json(
        F.struct(
            F.col("execution_id").alias("executionId"),
            F.col("source_file").alias("sourceFile"),
            F.col("error_reason").alias("errorReason"),
            F.date_format("timestamp", ISO_INSTANT).alias("timestamp"),
        )
    )
    return records.select("source_file", line.alias("value"))


def errors_per_file(errors: DataFrame, file: str = "source_file") -> DataFrame:
    """Errors of every file and, with a NULL file, of the run.

    The total is taken from the per-file counts, so the errors are aggregated once.
    """
    counts = errors.groupBy(file).agg(F.count("*").alias("errors"))
    return counts.rollup(file).agg(F.sum("errors").alias("errors"))


def first_errors(
    errors: DataFrame, n: int = 5, file: str = "source_file", order: list | None = None
) -> DataFrame:
    """The first ``n`` errors of every file.

    Spark keeps ``n`` rows per file before the shuffle (WindowGroupLimit), so a file that
    holds most errors does not load one task.
    """
    in_file = Window.partitionBy(file).orderBy(*(order or ["_at"]))
    return errors.withColumn("position", F.row_number().over(in_file)).filter(
        F.col("position") <= n
    )
