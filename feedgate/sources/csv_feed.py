"""CSV feeds: lines in, one raw text column per contract column out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from feedgate.contract import TableContract
from feedgate.functions import csv_cells
from feedgate.session import one_block_a_task, size_setting, work_dir
from feedgate.sources import csv_records
from feedgate.sources.inventory import GLOBS, FeedError, check_feed

# Separator, quote, escape and comment are line ends, the only characters no line can hold.  So
# Spark's CSV reader and writer handle whole lines, whatever stands in them, and do only what is
# wanted of them: drop or write the header of every file, and drop blank lines.
WHOLE_LINE = {"sep": "\r", "quote": "\n", "escape": "\n", "comment": "\n"}

#: Files whose layouts are broadcast: a path and the numbers of the contract's cells each.
MAX_FILES = 500_000


def line_order() -> Column:
    """Where a line stands in its feed: file, then byte block, then order inside the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.lit(0).alias("pos"),
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    header: str,
    check_header: bool = True,
    glob: str | None = None,
) -> DataFrame:
    """Data lines of CSV files, untouched, with their origin.

    Files are split into byte blocks and read in parallel.  With ``check_header`` Spark
    compares the first line of every file with ``header`` (any case) and fails the read if
    one differs.
    """
    schema = T.StructType([T.StructField(header, T.StringType())])
    reader = spark.read.schema(schema).options(**WHOLE_LINE).option("header", True)
    reader = reader.option("enforceSchema", not check_header)
    if isinstance(path, str):
        reader = reader.option("pathGlobFilter", glob or GLOBS["csv"])
    line = F.col("`" + header.replace("`", "``") + "`")
    lines = reader.csv(path).select(
        line.alias("line"),
        F.col("_metadata.file_path").alias("_source_file"),
        line_order().alias("_at"),
        F.col("_metadata.file_modification_time").alias("_source_time"),
    )
    return lines.filter(~csv_records.is_blank(F.col("line")))


def read_long_files(spark: SparkSession, path: str, header: str, check_header: bool = True, glob: str | None = None) -> DataFrame:
    """As ``read_lines``, for files that fill tasks of their own: lines as text, without Spark's CSV parser.

    Most of the time of reading and parsing short lines went to that parser.  With one block in a task, a
    file's header is the first line of the task of its first block.
    """
    reader = one_block_a_task(spark).read.option("pathGlobFilter", glob or GLOBS["csv"])
    text = reader.text(path).select(
        # Bytes that are no UTF-8 become U+FFFD, as in Spark's CSV reader.
        F.expr("make_valid_utf8(value)").alias("line"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("_source_time"),
    )
    rows = text.filter(~csv_records.is_blank(F.col("line"))).withColumn("seq", F.monotonically_increasing_id())
    first = (F.col("block") == 0) & (F.col("seq").bitwiseAND(F.lit((1 << 33) - 1)) == 0)
    if check_header:
        other = F.concat(F.lit("the CSV header does not conform to the first file's in "), F.col("_source_file"))
        fails = first & (F.lower("line") != header.lower())
        first = F.when(fails, F.raise_error(other).cast("boolean")).otherwise(first)
    return rows.filter(~first).select(
        "line", "_source_file",
        F.struct(F.col("_source_file").alias("file"), "block", "seq", F.lit(0).alias("pos")).alias("_at"),
        "_source_time",
    )


def first_header(spark: SparkSession, first_path: str) -> str:
    head = spark.read.text(first_path).head(1)
    if not head:
        raise FeedError(f"no header line in {first_path}")
    return head[0].value


def file_headers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``_source_file, header``: the first line of each file, by one pass over the text."""
    reader = spark.read.option("pathGlobFilter", glob or GLOBS["csv"])
    first = reader.text(path).select(
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.xxhash64("_metadata.file_path").alias("file_id"),
        F.col("value").alias("header"),
    )

    # Defined here so that it travels by value and workers need not have this package.
    def firsts(batches):
        """The row behind each change of file; a file's first block stands in one task."""
        import numpy as np

        last = None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            new = np.append(ids[0] != last, ids[1:] != ids[:-1])
            last = ids[-1]
            yield batch.take(np.flatnonzero(new)).select(["_source_file", "header"])

    wanted = first.filter(F.col("block") == 0).select("file_id", "_source_file", "header")
    return wanted.mapInArrow(firsts, "_source_file string, header string")


def layouts(headers: DataFrame, contract: TableContract) -> DataFrame:
    """``_source_file, _numbers, _width``: the cell of each contract column in the files, -1 if absent.

    Names match in any case and the first match wins.
    """
    cells = F.transform(csv_cells.cells(F.col("header")), csv_cells.unquoted)
    names = F.transform(cells, lambda c: F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")))
    named = headers.withColumn("names", names)
    numbers = [(F.array_position("names", c.lower()) - 1).cast("int") for c in contract.columns]
    return named.select("_source_file", F.array(*numbers).alias("_numbers"), F.size("names").alias("_width"))


def bind_by_file(lines: DataFrame, headers: DataFrame, contract: TableContract) -> DataFrame:
    """As ``bind_cells``, each file by its own header; one scan of the lines for all layouts."""
    spark = lines.sparkSession
    place = work_dir(spark, "csv-layouts")
    layouts(headers, contract).write.parquet(place)
    found = spark.read.parquet(place)
    size = found.agg(F.count("*").alias("files"), F.max("_width").alias("width")).first()
    if size.files <= MAX_FILES:
        found = F.broadcast(found.drop("_width"))
    placed = lines.join(found, "_source_file").select("_source_file", "_at", "_source_time", "line", "_numbers")
    values = csv_cells.values_of(placed, size.width or 1)
    columns = [
        F.nullif(F.get("_values", F.get("_numbers", F.lit(i))), F.lit("")).alias(c)
        for i, c in enumerate(contract.columns)
    ]
    return values.select("_source_file", "_at", "_source_time", *columns)


def _positions(header: str, contract: TableContract) -> dict[str, int]:
    """Contract column -> cell number; names match in any case and the first match wins."""
    names = csv_cells.header_cells(header)
    return {c: names.index(c.lower()) for c in contract.columns if c.lower() in names}


def bind_cells(lines: DataFrame, header: str, contract: TableContract) -> DataFrame:
    """Cut lines into cells and name the contract's ones; short rows and absent columns are NULL."""
    at = _positions(header, contract)
    columns = [
        F.col(c) if c in at else F.lit(None).cast("string").alias(c) for c in contract.columns
    ]
    return csv_cells.bound(lines, at).select("_source_file", "_at", "_source_time", *columns)


def read_csv_feed(
    spark: SparkSession,
    path: str,
    contract: TableContract,
    headers: str = "shared",
    multiline: bool = False,
    glob: str | None = None,
    skip_empty: bool = False,
    checked: Row | None = None,
) -> DataFrame:
    """A CSV feed as raw text columns, one row per data line.

    ``headers="shared"`` (one pass): all files carry the header of the first; the read fails if
    one does not.  ``headers="per_file"``: files may order their columns differently, found by
    one more pass over the text.  ``multiline`` keeps line breaks in quoted cells; files are split
    into blocks all the same (:mod:`feedgate.sources.csv_records`).  ``checked`` is the feed's
    summary if it was checked before.
    """
    summary = checked or check_feed(spark, path, "csv", glob, skip_empty)
    if headers not in ("shared", "per_file"):
        raise ValueError(f"headers must be 'shared' or 'per_file', not {headers!r}")
    if multiline:
        return _read_multiline(spark, path, summary.first_path, contract, headers, glob)
    header = first_header(spark, summary.first_path)
    # Short files share tasks, which Spark's reader can tell apart; see ``read_long_files``.
    long = summary.total_bytes >= summary.file_count * size_setting(spark, "spark.sql.files.openCostInBytes")
    read = read_long_files if long else read_lines
    lines = read(spark, path, header, headers == "shared", glob)
    if headers == "shared":
        return bind_cells(lines, header, contract)
    return bind_by_file(lines, file_headers(spark, path, glob), contract)


def first_record(records: DataFrame, first_path: str) -> str:
    """The header record of a feed's first file."""
    head = records.filter((F.col("_source_file") == first_path) & F.col("_first")).select("line").head()
    if head is None:
        raise FeedError(f"no header line in {first_path}")
    return head.line


def data_records(records: DataFrame, header: str) -> DataFrame:
    """Records without the files' headers; fails where one differs from ``header`` (in any case)."""
    other = F.concat(F.lit("the header differs from the first file's in "), F.col("_source_file"))
    same = F.lower("line") == header.lower()
    first = F.when(F.col("_first") & ~same, F.raise_error(other).cast("boolean")).otherwise(F.col("_first"))
    return records.filter(~first)


def _read_multiline(
    spark: SparkSession, path: str, first_path: str, contract: TableContract, headers: str, glob: str | None
) -> DataFrame:
    records = csv_records.read_records(spark, path, glob)
    if headers == "per_file":
        own = records.filter("_first").select("_source_file", F.col("line").alias("header"))
        return bind_by_file(records.filter(~F.col("_first")), own, contract)
    header = first_record(records, first_path)
    return bind_cells(data_records(records, header), header, contract)
