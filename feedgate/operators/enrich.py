"""Run metadata on loadable rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F


def new_run_id() -> str:
    """One identifier per run, shared by all its files."""
    return str(uuid.uuid4())


def stamped(rows: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Add ingestion time (one instant per run), run id and the source file's time."""
    uuid.UUID(run_id)  # refuses anything but an identifier
    return rows.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if at is None else at,
            "execution_id": F.lit(run_id),
            "source_creation_time": F.col("_source_time"),
        }
    )
