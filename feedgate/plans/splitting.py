"""Splitting a large feed into parts of a given size, without changing a value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedgate.session import block_session, work_dir
from feedgate.sinks import feed_writer
from feedgate.sources import csv_feed, csv_records, json_chunks, json_feed
from feedgate.sources.inventory import GLOBS, FeedError, check_feed, feed_inventory


def part_count(total_bytes, threshold_bytes: int):
    """``max(1, ceil(bytes / threshold))`` as a column expression."""
    return F.greatest(F.lit(1), F.ceil(total_bytes / F.lit(threshold_bytes)))


def needs_split(inventory: DataFrame, threshold_bytes: int) -> DataFrame:
    """The inventory with ``oversized`` (strictly above the threshold) and ``parts``."""
    return inventory.withColumn("oversized", F.col("bytes") > threshold_bytes).withColumn(
        "parts", part_count(F.col("bytes"), threshold_bytes)
    )


def split_feed(
    spark: SparkSession,
    path: str,
    out: str,
    fmt: str,
    threshold_bytes: int,
    prefix: str | None = None,
    layout: str = "document",
    glob: str | None = None,
    skip_empty: bool = False,
) -> DataFrame:
    """Write the feed as parts of about ``threshold_bytes`` and return the parts' inventory.

    Parts follow each other in feed order, so a run over them loads the same rows as one over the
    feed.  CSV parts carry the header each and end between records; lines are copied and not
    shuffled, unless a quoted cell holds a line break: then whole records are.  JSON lines are copied likewise.  Arrays become one array per part, a single record an
    element among them; a document that cannot be parsed is a part of its own, as sent.

    Parts keep Spark's names (read JSON parts with the glob ``part-*``).  With ``prefix`` they are
    called ``<prefix>_part_001.<fmt>`` and so on, by one rename per part on the driver.
    """
    if threshold_bytes <= 0:
        raise ValueError("threshold_bytes must be positive")
    summary = check_feed(spark, path, fmt, glob, skip_empty)
    parts = max(1, -(-summary.total_bytes // threshold_bytes))
    if fmt == "csv":
        header = csv_feed.first_header(spark, summary.first_path)
        session = block_session(spark, threshold_bytes)
        lines = csv_feed.read_lines(session, path, header, glob=glob).select("line")
        quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
        if not lines.filter(quotes % 2 == 1).isEmpty():
            _split_csv_records(spark, path, out, summary.first_path, threshold_bytes, parts, glob)
        else:
            _require_records(lines)
            feed_writer.write_csv_lines(lines, header, out)
    elif layout == "lines":
        session = block_session(spark, threshold_bytes)
        reader = session.read.option("pathGlobFilter", glob or GLOBS["json"])
        lines = reader.text(path).filter(~F.col("value").rlike(r"^\s*$"))
        _require_records(lines)
        feed_writer.write_json_lines(lines.select(F.col("value").alias("element")), out)
    else:
        _split_documents(spark, path, out, threshold_bytes, parts, glob)
    if prefix is None:
        written = feed_inventory(spark, out, fmt, "part-*")
    else:
        feed_writer.name_parts(spark, out, prefix, fmt)
        written = feed_inventory(spark, out, fmt)
    if written.isEmpty():
        raise FeedError("the feed holds no records: no parts written")
    return written


def _split_csv_records(
    spark: SparkSession, path: str, out: str, first_path: str, threshold_bytes: int, parts: int, glob: str | None
) -> None:
    """Records with quoted line breaks, copied as they are; part k begins at k times the threshold.

    Records are cut in parallel and written once; their bytes before each file (one row per file)
    and in it give their part, so that no part is larger than the threshold and one record.
    """
    place = work_dir(spark, "csv-records")
    csv_records.read_records(spark, path, glob).write.parquet(place)
    records = spark.read.parquet(place)
    header = csv_feed.first_record(records, first_path)
    before = Window.orderBy("_source_file").rowsBetween(Window.unboundedPreceding, -1)
    files = records.groupBy("_source_file").agg(F.max(F.col("_offset") + F.col("_bytes")).alias("bytes"))
    files = files.select("_source_file", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_start"))
    data = csv_feed.data_records(records, header).join(files, "_source_file")
    part = F.floor((F.col("_start") + F.col("_offset")) / F.lit(threshold_bytes)).cast("int")
    dealt = data.repartitionById(parts, part).sortWithinPartitions("_source_file", "_offset")
    feed_writer.write_csv_records(dealt.select("line"), header, out)


def _split_documents(
    spark: SparkSession, path: str, out: str, threshold_bytes: int, parts: int, glob: str | None
) -> None:
    # Lots small against a part, so that parts come out even.
    lot_bytes = max(1, min(json_chunks.PACK_BYTES, threshold_bytes // 64))
    chunks = json_chunks.staged_chunks(spark, path, glob=glob, pack_bytes=lot_bytes)
    others = json_chunks.other_documents(chunks)
    arrays = json_chunks.arrays_only(chunks, others)
    broken = {r._source_file for r in json_chunks.broken_arrays(arrays).toLocalIterator()}
    elements = json_chunks.raw_elements(json_chunks.arrays_only(arrays, sorted(broken)))
    if others:
        texts = json_feed.document_texts(spark, path, F.col("_metadata.file_path").isin(others), glob)
        record = F.try_parse_json("value")
        wrong = texts.filter(record.isNull()).select("_source_file")
        broken |= {r._source_file for r in wrong.toLocalIterator()}
        # As sent, unless something stands behind the record that a parser of the whole passes over.
        alone = F.size(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<variant>")) == 1
        single = texts.filter(record.isNotNull()).select(
            "_source_file", F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("seq"),
            F.when(alone, F.trim("value")).otherwise(F.to_json(record)).alias("element"),
        )
        elements = elements.unionByName(single)
    order = ["_source_file", "block", "seq"]
    ordered = elements.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    feed_writer.write_json_arrays(ordered.select("element"), out)
    if broken:  # each a file of its own, as its error is its own; one write for all of them
        texts = json_feed.document_texts(spark, path, F.col("_metadata.file_path").isin(sorted(broken)), glob)
        numbers = spark.createDataFrame(list(enumerate(sorted(broken))), "_part int, _source_file string")
        alone = texts.join(F.broadcast(numbers), "_source_file").repartitionById(len(broken), "_part")
        alone.select("value").write.mode("append").text(out)


def _require_records(lines: DataFrame) -> None:
    if lines.isEmpty():
        raise FeedError("the feed holds no records: no parts written")
