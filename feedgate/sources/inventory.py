"""The files of a feed directory and the checks made before anything is read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Suffixes in any case.
GLOBS = {"csv": "*.[cC][sS][vV]", "json": "*.[jJ][sS][oO][nN]"}


class FeedError(ValueError):
    """A feed, manifest or run that cannot be accepted."""


def file_format(name: str) -> str:
    """``csv`` or ``json`` by extension; anything else is refused."""
    extension = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if extension not in GLOBS:
        raise FeedError(f"feeds are csv or json files, not {extension or name!r}")
    return extension


def feed_inventory(
    spark: SparkSession, path: str, fmt: str, glob: str | None = None
) -> DataFrame:
    """One row per feed file: path, name, bytes, modification time.  No content is read.

    Files are those with the format's suffix, in any case, or those matching ``glob``.  Spark
    scans no files of zero bytes, so they have no row; ``empty_files`` finds them.
    """
    if fmt not in GLOBS:
        raise FeedError(f"feeds are csv or json files, not {fmt!r}")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob or GLOBS[fmt])
    return reader.load(path).select(
        "path",
        F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def empty_files(inventory: DataFrame, with_content: int) -> list[str]:
    """Names of zero-byte files: those Spark's file index lists beyond the files with content."""
    listed = inventory.inputFiles()
    if len(listed) == with_content:
        return []
    full = {_plain(row.path) for row in inventory.select("path").toLocalIterator()}
    return sorted(path for path in listed if _plain(path) not in full)


def _plain(path: str) -> str:
    """A path without the varying number of slashes behind its scheme."""
    return re.sub("^([a-z0-9]+):/+", r"\1:/", path)


def inventory_summary(inventory: DataFrame, threshold_bytes: int | None = None) -> DataFrame:
    """File count, bytes, largest file, and with a threshold how many files exceed it."""
    sums = [
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.coalesce(F.max("bytes"), F.lit(0)).cast("bigint").alias("largest_bytes"),
        F.min("path").alias("first_path"),
    ]
    if threshold_bytes is not None:
        sums.append(F.count_if(F.col("bytes") > threshold_bytes).alias("oversized_files"))
    return inventory.agg(*sums)


def check_feed(
    spark: SparkSession, path: str, fmt: str, glob: str | None = None, skip_empty: bool = False
):
    """Refuse a feed without files or with an empty file; return its summary row.

    ``skip_empty`` is for folders Spark wrote, where a task without rows may leave an empty file.
    """
    try:
        files = feed_inventory(spark, path, fmt, glob)
        summary = inventory_summary(files).first()
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FeedError(f"no feed at {path}") from problem
        raise
    empty = [] if skip_empty else empty_files(files, summary.file_count)
    if empty:
        raise FeedError(f"feed files of zero bytes: {', '.join(empty)}")
    if summary.file_count == 0:
        raise FeedError(f"nothing that looks like {fmt} at {path}")
    return summary
