"""Appending to the target."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedgate.contract import TableContract


def append_parquet(rows: DataFrame, path: str) -> None:
    """Append new rows.  Spark commits the files of a job together; a failed job adds none."""
    rows.write.mode("append").parquet(path)


def append_bucketed(rows: DataFrame, table: str, contract: TableContract) -> None:
    """Append to a bucketed table.  Co-located ``new_rows`` come in the table's buckets, so every
    task writes one file and not one per bucket."""
    rows.select(*[f.name for f in contract.target_schema]).write.insertInto(table)
