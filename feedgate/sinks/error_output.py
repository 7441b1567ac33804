"""Error lines, one folder per run and feed file."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedgate.operators.errors import error_lines


def write_errors(records: DataFrame, path: str, run_id: str, one_file_each: bool = False) -> None:
    """Write error records as JSON lines below ``path/execution_id=<run>/feed_file=<name>/``.

    Only this run's folder is written, so the errors of earlier runs stay; writing a run again
    replaces its own.  Every task writes its own file.  ``one_file_each`` gathers each feed file's errors into
    one output file, by a shuffle on the feed file: only for feeds with few errors per file.
    """
    lines = error_lines(records).select(
        F.regexp_extract("source_file", "([^/]*)$", 1).alias("feed_file"), "value"
    )
    if one_file_each:
        lines = lines.repartition("feed_file")
    lines.write.mode("overwrite").partitionBy("feed_file").text(f"{path}/execution_id={run_id}")
