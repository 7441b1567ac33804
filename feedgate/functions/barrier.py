"""Keeping expensive message columns from being copied by the optimizer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def computed_once(message: Column) -> Column:
    """A message column that filters are not pushed through.

    Spark copies the expression behind a filtered column down to the scan.  For a column that
    depends on every field, that copy would parse every field again, many times over.  An
    expression it cannot repeat stays where it is; the added branch never applies.
    """
    return F.coalesce(message, F.when(F.monotonically_increasing_id() < 0, F.lit("")))
