"""Manifests: small ``key=value`` files that announce a feed file and its row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The keys and messages of the announced format, which result rows carry.
REQUIRED = ("file_name", "file_path", "record_count")


def read_manifests(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """One row per manifest file with its values, violations and the count as a number.

    The usual rules of property files: ``#`` and ``!`` lines are comments, a line that ends in a
    backslash goes on, a backslash takes the next character as it is, keys end at ``=``, ``:`` or
    white space, and the last of a repeated key counts.  Values are trimmed of white space.
    """
    manifests = (
        spark.read.option("pathGlobFilter", glob)
        .text(path, wholetext=True)  # a few lines each
        .select(F.col("_metadata.file_path").alias("manifest"), "value")
    )
    joined = F.regexp_replace("value", r"(?<!\\)((?:\\\\)*)\\(?:\r\n|\r|\n)[ \t\f]*", "$1")
    lines = manifests.select(
        "manifest", F.posexplode(F.split(joined, r"\r\n|\r|\n")).alias("at", "line")
    ).filter(~F.col("line").rlike(r"^\s*([#!]|$)"))
    pair = r"^\s*((?:[^=:\s\\]|\\.)*)\s*[=:]?\s*(.*)$"
    pairs = lines.select(
        "manifest",
        "at",
        _unescaped(F.regexp_extract("line", pair, 1)).alias("key"),
        _unescaped(F.regexp_replace(F.regexp_extract("line", pair, 2), r"\s+$", "")).alias("text"),
    )
    values = [
        F.nullif(
            F.max_by(F.col("text"), F.when(F.col("key") == key, F.col("at"))), F.lit("")
        ).alias(key)
        for key in REQUIRED
    ]
    found = pairs.groupBy("manifest").agg(*values)
    # A manifest without a single pair is reported, too.
    return manifest_checks(manifests.select("manifest").join(found, "manifest", "left"))


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def manifest_checks(manifests: DataFrame) -> DataFrame:
    """Add ``expected_records`` and ``violation`` (the first broken rule) to manifest values."""
    # Messages: fixed values, as above.
    count = F.when(
        F.col("record_count").rlike(r"^[+-]?\d+$"), F.col("record_count").try_cast("bigint")
    )
    missing = [
        F.when(F.col(key).isNull(), F.lit(f"{key} is missing in control file"))
        for key in REQUIRED
    ]
    return manifests.withColumn("expected_records", count).withColumn(
        "violation",
        F.coalesce(
            *missing,
            F.when(F.col("expected_records").isNull(), "record_count must be a valid number"),
            F.when(F.col("expected_records") < 0, "record_count cannot be negative"),
        ),
    )
