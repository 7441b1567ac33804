"""Insert-if-absent: the first row of each key, unless the target has the key already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedgate.contract import STAMPS, Field, TableContract
from feedgate.session import work_dir


def first_wins(rows: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """The first row of every key in feed order (file, then position).

    ``row_number() = 1`` lets Spark drop later duplicates before the shuffle, one row per key
    and task, so a key that fills a third of the feed costs no more than any other.
    """
    per_key = Window.partitionBy(key).orderBy(*(order or ["_at"]))
    return (
        rows.withColumn("_nth", F.row_number().over(per_key))
        .filter(F.col("_nth") == 1)
        .drop("_nth")
    )


def existing_keys(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Target keys the rows also carry.

    Built on the side of the rows: for a small feed Spark broadcasts its keys (by their
    measured size) and the target is scanned for one column without being shuffled.
    """
    return target.select(key).join(rows.select(key).distinct(), key, "left_semi")


def new_rows(rows: DataFrame, target: DataFrame, key: str, order: list | None = None) -> DataFrame:
    """Rows to insert: one per key, keys absent from the target.

    For rows that are not written yet; ``rows_to_insert`` gives the same without moving them.
    """
    keyed = rows.filter(F.col(key).isNotNull())
    return first_wins(keyed, key, order).join(existing_keys(target, keyed, key), key, "left_anti")


def absent_rows(first: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows, one per key, whose keys a target bucketed by key does not have.

    In a session with as many shuffle partitions as buckets (``session.bucket_session``) the
    target joins where it lies, however large it is, and only the new rows move.
    """
    return first.join(target.select(key), key, "left_anti")


#: The column of order numbers; bits of a number for the place inside a block; of these, where a
#: line or lot holds several records, bits for the record.
ORDER = "_order"
PLACE_BITS = 40
RECORD_BITS = 25


def numbered(rows: DataFrame, row_id: str) -> tuple[DataFrame, str]:
    """Written rows with a whole number that grows in feed order and is unique, and its name.

    The rank of the row's file and block stands in the high bits, its place there in the low ones.
    Ranks come from one row per block, 800,000 for 100 TB.  Rows whose ``_at`` has another form, or
    places that do not fit, stay as they are and keep ``row_id``.
    """
    if rows.schema["_at"].dataType.simpleString() != "struct<file:string,block:bigint,seq:bigint,pos:int>":
        return rows, row_id
    spark = rows.sparkSession
    # A line's number counts the rows of its task; the task itself stands in the upper bits.
    line = F.col("_at.seq").bitwiseAND(F.lit((1 << 33) - 1))
    path = work_dir(spark, "feed-blocks")
    rows.groupBy(F.col("_at.file").alias("file"), F.col("_at.block").alias("block")).agg(
        F.max("_at.seq").alias("seq"), F.max("_at.pos").alias("pos")
    ).write.parquet(path)
    blocks = spark.read.parquet(path)
    size = blocks.agg(F.count("*").alias("n"), F.max("seq").alias("seq"), F.max("pos").alias("pos")).first()
    if not size.n or size.n >= 1 << (63 - PLACE_BITS):
        return rows, row_id
    if size.pos == 0:
        place = line
    elif size.pos < 1 << RECORD_BITS and size.seq < 1 << (PLACE_BITS - RECORD_BITS):
        place = F.shiftleft(F.col("_at.seq"), RECORD_BITS) + F.col("_at.pos")
    else:
        return rows, row_id
    rank = F.row_number().over(Window.orderBy("file", "block")).cast("bigint")
    ranks = blocks.select("file", "block", F.shiftleft(rank, PLACE_BITS).alias("_rank"))
    placed = rows.join(ranks, (F.col("_at.file") == ranks.file) & (F.col("_at.block") == ranks.block))
    return placed.select(*rows.columns, (F.col("_rank") + place).alias(ORDER)), ORDER


def key_table(rows: DataFrame, key: str, row_id: str, loadable: Column) -> DataFrame:
    """Every key once: its rows (``n``) and the id of its first loadable row (``first_id``).

    One narrow aggregate, combined per task, from which load and reconciliation both start.  By
    order numbers it hashes; by positions of another form Spark has to sort for it.
    """
    if row_id == ORDER:
        first = F.min(F.when(loadable, F.col(ORDER)))
    else:
        first = F.min_by(row_id, F.when(loadable, F.col("_at")))
    return rows.groupBy(F.col(key).alias("key")).agg(
        F.count("*").alias("n"), first.alias("first_id")
    )


def rows_to_insert(
    spark: SparkSession,
    rows: DataFrame,
    keys: DataFrame,
    target: DataFrame | None,
    key: str,
    row_id: str,
) -> DataFrame:
    """The rows ``new_rows`` would give, of a written table with unique row ids and a key table.

    Without a target these are the first rows of all keys.  Only keys and ids move.  The ids to insert are written first, so that their number and size
    are known.  Most loads insert nearly all rows or nearly none: then few ids are left to drop
    or to keep, Spark broadcasts them by their file size, and the rows are never shuffled.
    """
    path = work_dir(spark, "insert-ids")
    candidates = keys.filter("key is not null and first_id is not null").withColumnRenamed(
        "key", key
    )
    if target is not None:
        candidates = candidates.join(existing_keys(target, candidates, key), key, "left_anti")
    candidates.select(F.col("first_id").alias(row_id)).write.parquet(path)
    ids = spark.read.parquet(path)
    wanted, given = ids.count(), rows.count()
    if wanted == given:
        return rows
    if 2 * wanted <= given:
        return rows.join(ids, row_id, "left_semi").select(*rows.columns)
    path = work_dir(spark, "drop-ids")
    rows.select(row_id).join(ids, row_id, "left_anti").write.parquet(path)
    return rows.join(spark.read.parquet(path), row_id, "left_anti").select(*rows.columns)


def target_projection(rows: DataFrame, contract: TableContract) -> DataFrame:
    """Exactly the target's columns: empty lists as NULL, fixed widths cut."""
    return rows.select(
        *[stored_value(f).alias(f.name) for f in contract.fields],
        *STAMPS.names,
    )


def stored_value(field: Field) -> Column:
    """A value in its stored form: an empty list is NULL, a fixed width is cut to."""
    value = F.col(field.name)
    if field.kind == "list":
        return F.when(F.size(value) > 0, value)
    if field.width:
        return F.substring(value, 1, field.width)
    return value
