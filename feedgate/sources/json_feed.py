"""JSON feeds: one variant per record.

A document is an array of records or a single record.  Documents up to a limit are parsed whole,
in parallel across files; larger ones are cut at record borders first
(:mod:`feedgate.sources.json_chunks`), so no document has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from feedgate.functions.json_fields import elements
from feedgate.sources import json_chunks
from feedgate.sources.inventory import GLOBS, check_feed

MALFORMED = json_chunks.MALFORMED
MALFORMED_LINE = "Malformed JSON line"

#: Documents above this size are cut, whatever the cluster; the records are the same either way.
MAX_DOCUMENT_BYTES = 32 * 1024 * 1024


def records_of(document: Column, inside: tuple[str, ...] = ()) -> Column:
    """Array elements, or the single root; NULL inside the array marks malformed text.

    With ``inside`` the elements of the array at that path of keys; without one the text is malformed.
    """
    if inside:
        at = "$" + "".join(f"['{key}']" for key in inside)
        nothing = F.array(F.try_parse_json(F.lit("no JSON text")))
        return F.coalesce(F.try_variant_get(F.try_parse_json(document), at, "array<variant>"), nothing)
    return F.coalesce(
        F.from_json(document, "array<variant>"), F.array(F.try_parse_json(document))
    )


def _reader(spark: SparkSession, glob: str | None):
    return spark.read.option("pathGlobFilter", glob or GLOBS["json"])


def read_json_feed(
    spark: SparkSession,
    path: str,
    layout: str = "document",
    max_document_bytes: int | None = None,
    glob: str | None = None,
    skip_empty: bool = False,
    checked: Row | None = None,
    inside: str | None = None,
) -> DataFrame:
    """A JSON feed as rows of (_source_file, _at, _source_time, _doc_error, record).

    ``layout="lines"`` reads one record per line: files are split freely and a malformed line
    spoils only itself.  ``checked`` is the feed's summary if it was checked before.  ``inside`` names
    the array that holds the records, such as ``data.items``, in documents that wrap it; its keys
    have no quotes, commas or backslashes.
    """
    path_of_keys = tuple(inside.split(".")) if inside else ()
    if any(set(key) & set("'\"\\,") or not key for key in path_of_keys):
        raise ValueError(f"not a path of plain keys: {inside!r}")
    summary = checked or check_feed(spark, path, "json", glob, skip_empty)
    if layout == "lines":
        return _read_lines(spark, path, glob)
    if layout != "document":
        raise ValueError(f"layout must be 'document' or 'lines', not {layout!r}")
    limit = MAX_DOCUMENT_BYTES if max_document_bytes is None else max_document_bytes
    small = _read_documents(spark, path, F.col("_metadata.file_size") <= limit, glob, path_of_keys)
    if summary.largest_bytes <= limit:
        return small
    return small.unionByName(read_large_documents(spark, path, limit, glob, inside=path_of_keys))


def read_large_documents(
    spark: SparkSession,
    path: str,
    above_bytes: int,
    glob: str | None = None,
    max_record_bytes: int = json_chunks.MAX_RECORD_BYTES,
    inside: tuple[str, ...] = (),
) -> DataFrame:
    """Records of all documents above a size: arrays cut at record borders, others parsed whole.

    With ``inside`` the array at that path of keys is cut, and a document without one is an error.
    A record of an array above ``max_record_bytes`` is an error in its place; the others load.
    What is no array is one record, which has to fit into one task whatever is done with it.
    """
    chunks = json_chunks.staged_chunks(
        spark, path, above_bytes, glob, max_record_bytes=max_record_bytes, inside=inside
    )
    if inside:
        found = json_chunks.records(chunks, refuse_oversized=False)
        return found.unionByName(json_chunks.without_array(spark, path, above_bytes, glob, chunks))
    others = json_chunks.other_documents(chunks)
    found = json_chunks.records(json_chunks.arrays_only(chunks, others), refuse_oversized=False)
    if not others:
        return found
    # A condition on paths: Spark opens no other file.
    return found.unionByName(_read_documents(spark, path, F.col("_metadata.file_path").isin(others), glob))


def _read_documents(
    spark: SparkSession, path: str, chosen: Column, glob: str | None, inside: tuple[str, ...] = ()
) -> DataFrame:
    documents = (
        _reader(spark, glob)
        .text(path, wholetext=True)
        # Sizes and paths are known from the listing: other files are not opened here.
        .filter(chosen)
        .select(
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_modification_time").alias("_source_time"),
            records_of(F.col("value"), inside).alias("records"),
        )
    )
    return elements(documents, "_source_file", "_source_time").select(
        "_source_file",
        F.struct(
            F.col("_source_file").alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            F.lit(0).cast("bigint").alias("seq"),
            "pos",
        ).alias("_at"),
        "_source_time",
        F.when(F.col("record").isNull(), MALFORMED).alias("_doc_error"),
        "record",
    )


def document_texts(spark: SparkSession, path: str, chosen: Column, glob: str | None) -> DataFrame:
    """``_source_file, value``: whole documents as sent, of the files a condition chooses."""
    texts = _reader(spark, glob).text(path, wholetext=True).filter(chosen)
    return texts.select(F.col("_metadata.file_path").alias("_source_file"), "value")


def _read_lines(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    record = F.try_parse_json("value")
    return (
        _reader(spark, glob)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("_source_file"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("seq"),
                F.lit(0).alias("pos"),
            ).alias("_at"),
            F.col("_metadata.file_modification_time").alias("_source_time"),
            "value",
        )
        .filter(~F.col("value").rlike(r"^\s*$"))
        .select("_source_file", "_at", "_source_time", record.alias("record"))
        .select(
            "_source_file",
            "_at",
            "_source_time",
            F.when(F.col("record").isNull(), MALFORMED_LINE).alias("_doc_error"),
            "record",
        )
    )
