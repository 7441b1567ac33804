"""Running totals over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of one block and blocks of one group; keeps every window partition small.
FAN = 65_536


def running_total(
    rows: DataFrame, position: str, value: Column, name: str, fan: int = FAN
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before each row, by ``position``.

    ``position`` is a unique whole number.  Rows are summed inside blocks of ``fan``
    neighbouring positions, blocks inside groups of ``fan`` blocks, and groups once more, so
    the order is global and each window partition holds at most ``fan`` rows.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(position) / fan)).withColumn(
        "_value", value
    )
    blocks = (
        blocked.groupBy("_block")
        .agg(F.sum("_value").alias("_size"))
        .withColumn("_group", F.floor(F.col("_block") / fan))
    )
    groups = blocks.groupBy("_group").agg(F.sum("_size").alias("_group_size"))
    # One row per fan * fan positions: 77 rows for 3.3e11 positions.
    group_starts = groups.select(
        "_group", _before(F.col("_group_size"), Window.orderBy("_group")).alias("_group_start")
    )
    block_starts = blocks.join(group_starts, "_group").select(
        "_block",
        (
            F.col("_group_start")
            + _before(F.col("_size"), Window.partitionBy("_group").orderBy("_block"))
        ).alias("_start"),
    )
    in_block = Window.partitionBy("_block").orderBy(position)
    return (
        blocked.join(block_starts, "_block")
        .withColumn(name, F.col("_start") + _before(F.col("_value"), in_block))
        .drop("_block", "_value", "_start")
    )


def _before(value: Column, window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))
