"""Counts after a run: does every input row end in the target or in the errors?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.contract import TableContract
from feedgate.functions import uuids
from feedgate.session import work_dir
from feedgate.sources.inventory import FeedError


def readable_key(contract: TableContract, raw: Column) -> Column:
    """The key as the load writes it, NULL where it cannot be read.

    Load and reconciliation share one canonical form, so they never count differently.
    """
    kind = next(f.kind for f in contract.fields if f.name == contract.key)
    return uuids.canonical(raw, contract.lenient_uuid) if kind == "uuid" else raw


def feed_keys(feed: DataFrame, key: Column) -> DataFrame:
    """Readable keys of a feed and their rows (``key``, ``n``); unreadable ones under NULL.

    Counts combine per task, so a key that fills a third of the feed is one row per task.
    """
    return feed.groupBy(key.alias("key")).agg(F.count("*").alias("n"))


def feed_counts(keys: DataFrame) -> DataFrame:
    """One row: input rows, distinct readable keys, rows that repeat an earlier key."""
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("input_records"),
        F.count_if(F.col("key").isNotNull()).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("n") - 1)), F.lit(0))
        .cast("bigint")
        .alias("duplicates_in_feed"),
    )


def records_per_file(feed: DataFrame) -> DataFrame:
    """Rows read from every feed file, by file name."""
    name = F.regexp_extract("_source_file", "([^/]*)$", 1)
    return feed.groupBy(name.alias("file_name")).agg(F.count("*").alias("input_records"))


def target_counts(target: DataFrame, run_id: Column) -> DataFrame:
    """One row: rows of this run and all rows, in one pass."""
    return target.agg(
        F.count_if(F.col("execution_id") == run_id).alias("new_records"),
        F.count("*").alias("total_records"),
    )


def matched_count(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One row: target rows whose key the feed carries.  A semi join, never a key list."""
    renamed = keys.select(F.col("key").alias(key))
    return target.select(key).join(renamed, key, "left_semi").agg(
        F.count("*").alias("matched_records")
    )


def verdict(
    counts: DataFrame, errors: DataFrame, matched: DataFrame, target: DataFrame
) -> DataFrame:
    """The one-row reconciliation report from four one-row aggregates."""
    one = counts.select(
        "*",
        errors.select("error_records").scalar().alias("error_records"),
        matched.select("matched_records").scalar().alias("matched_records"),
        target.select("new_records").scalar().alias("new_records"),
        target.select("total_records").scalar().alias("total_records"),
    )
    return (
        one.withColumn("expected_records", F.col("input_records") - F.col("error_records"))
        .withColumn("existing_records", F.col("matched_records") - F.col("new_records"))
        .withColumn("accounted_records", F.col("existing_records") + F.col("new_records"))
        .withColumn(
            "status",
            F.when(F.col("accounted_records") == F.col("expected_records"), "passed").otherwise(
                "mismatch"
            ),
        )
    )


def reconcile(
    keys: DataFrame,
    errors: DataFrame,
    target: DataFrame,
    key: str,
    run_id: str,
) -> DataFrame:
    """Reconcile a run from its ``feed_keys``, its errors and the target.

    ``duplicates_in_feed`` explains a mismatch that repeated keys cause.
    """
    return verdict(
        feed_counts(keys),
        errors.agg(F.count("*").alias("error_records")),
        matched_count(target, keys, key),
        target_counts(target, F.lit(run_id)),
    )


def require_passed(report: DataFrame) -> None:
    """Fail the run on a mismatch."""
    row = report.first()
    if row.status != "passed":
        raise FeedError(
            f"{row.accounted_records} of {row.expected_records} loadable rows are in the target"
        )


def control_totals(manifests: DataFrame, rows_per_file: DataFrame) -> DataFrame:
    """Announced against read rows, per manifest (``file_name`` -> ``input_records``)."""
    joined = manifests.join(rows_per_file, "file_name", "left")
    read = F.coalesce("input_records", F.lit(0))
    return joined.select(
        "file_name",
        "expected_records",
        read.alias("input_records"),
        "violation",
        F.when(F.col("violation").isNotNull(), "refused")
        .when(F.col("input_records").isNull(), "missing")
        .when(read == F.col("expected_records"), "matched")
        .otherwise("mismatch")
        .alias("status"),
    )


def run_summary(
    report: DataFrame, run_id: str, directory: str, fmt: str, files: int, split: bool
) -> DataFrame:
    """One row that describes a finished run."""
    return report.select(
        F.lit(run_id).alias("execution_id"),
        F.lit(directory).alias("input_directory"),
        F.lit(fmt).alias("file_format"),
        F.lit(files).cast("bigint").alias("input_file_count"),
        F.lit(split).alias("split"),
        F.current_timestamp().alias("finished_at"),
        F.when(F.col("status") == "passed", "success").otherwise("failed").alias("state"),
        *report.columns,
    )


#: Buckets of the first comparison, and of each bucket that differs in it.
BUCKETS = 4096


def _buckets(keys: DataFrame, key: str) -> DataFrame:
    """Distinct keys with the two buckets their hash puts them in; null keys are left out."""
    hashed = keys.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key")).withColumn("hash", F.xxhash64("key"))
    return hashed.withColumns(
        {
            "top": F.pmod("hash", F.lit(BUCKETS)).cast("int"),
            "sub": F.pmod(F.shiftrightunsigned("hash", 20), F.lit(BUCKETS)).cast("int"),
        }
    )


def _digests(keys: DataFrame, by: list[str]) -> DataFrame:
    """Count and two order-free digests per bucket: three numbers, combined per task."""
    other = F.xxhash64("hash", "key")
    return keys.groupBy(*by).agg(
        F.count("*").alias("n"), F.bit_xor("hash").alias("x"), F.sum(F.pmod(other, F.lit(1 << 40))).alias("s")
    )


def _unequal(left: DataFrame, right: DataFrame, by: list[str], label: str) -> DataFrame | None:
    """Buckets whose digests differ, written; None without any."""
    spark = left.sparkSession
    a, b = _digests(left, by), _digests(right, by)
    same = " and ".join(f"l.{c} <=> r.{c}" for c in ("n", "x", "s"))
    both = a.alias("l").join(b.alias("r"), by, "full").filter(f"not ({same})").select(*by)
    path = work_dir(spark, label)
    both.write.parquet(path)
    found = spark.read.parquet(path)
    return None if found.isEmpty() else found


def differing_keys(feed: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``key, side``: keys of the feed that the target lacks (``missing``), and the reverse (``extra``).

    Both sides are compared by digests of hash buckets first, then those buckets that differ by the
    digests of theirs; only keys of buckets that differ in both are joined.  Equal sides are read
    once, for the digests.  Keys may repeat: a bucket that differs only by that yields nothing.
    """
    spark = feed.sparkSession
    left, right = _buckets(feed, key), _buckets(target, key)
    tops = _unequal(left, right, ["top"], "unequal-buckets")
    if tops is not None:
        # Broadcast: BUCKETS numbers at most.
        left, right = (side.join(F.broadcast(tops), "top", "left_semi") for side in (left, right))
        subs = _unequal(left, right, ["top", "sub"], "unequal-keys")
    if tops is None or subs is None:
        return spark.createDataFrame([], "key string, side string")
    found = [
        side.join(subs, ["top", "sub"], "left_semi").select("key").distinct().withColumn(name, F.lit(True))
        for side, name in ((left, "fed"), (right, "stored"))
    ]
    both = found[0].join(found[1], "key", "full").filter("fed is null or stored is null")
    return both.select("key", F.when(F.col("fed"), "missing").otherwise("extra").alias("side"))
