"""Written intermediate tables, global order and running totals shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedgate.session import work_dir

#: ASCII white space as the contracts count it: blank and \\t \\n \\v \\f \\r.
SPACES = "[\\x20\\x09-\\x0D]+"
WORDS = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write below ``spark.checkpoint.dir`` and read back: a short lineage that survives executors."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether the fold of a document keeps its label from training; null ids count as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows in one global order, written, with ``_at``: partition (high bits) and row in it.

    The whole sort key takes part in range partitioning, so a hot leading value is spread over
    many partitions.  Writing fixes the partitions: a range sort computed twice may cut elsewhere.
    """
    return staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    )


def _part() -> Column:
    return F.shiftright(F.col("_at"), 33).alias("_part")


def _starts(placed: DataFrame, value: Column) -> DataFrame:
    """What stands before each partition: one row per shuffle partition, so one small window."""
    totals = placed.groupBy(_part()).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))


def with_rank(placed: DataFrame, name: str) -> DataFrame:
    """Add the position from 0 in the global order of ``in_order``; no window over rows."""
    # Broadcast: one row of two numbers per shuffle partition, whatever the input.
    starts = F.broadcast(_starts(placed, F.lit(1)))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", _part())
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_part", "_start", "_at")
    )


def with_running(placed: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` up to and with each row of the global order of ``in_order``."""
    inside = Window.partitionBy("_part").orderBy("_at")
    starts = F.broadcast(_starts(placed, F.col(value)))  # as in with_rank
    return (
        placed.withColumn("_part", _part())
        .withColumn("_inside", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(starts, "_part")
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_part", "_start", "_inside", "_at")
    )
