"""Refused CSV records read again from their byte positions, without reading the feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bytes fetched at once; a longer record takes more of them.
FETCH_BYTES = 1 << 14


def _fetcher(fetch_bytes: int):
    """Task-side reads.  Nested, so that they travel by value to the workers."""
    import re
    from urllib.parse import unquote, urlsplit

    import pyarrow as pa
    from pyarrow import fs

    def opened(uri):
        parts = urlsplit(uri)
        if parts.scheme in ("", "file"):
            return fs.LocalFileSystem().open_input_file(unquote(parts.path))
        system, path = fs.FileSystem.from_uri(uri)
        return system.open_input_file(path)

    def record(source, offset):
        """The text from an offset to the line end outside quotes, and the bytes fetched."""
        source.seek(offset)
        data, at, inside, fetched = b"", 0, False, 0
        while True:
            more = source.read(fetch_bytes)
            fetched += len(more)
            data += more
            for m in re.compile(b'["\n]').finditer(data, at):
                if m[0] == b'"':
                    inside = not inside
                elif not inside:
                    line = data[: m.start()]
                    return line[:-1] if line.endswith(b"\r") else line, fetched
            if not more:
                return data, fetched
            at = len(data)

    def rows(batches):
        source, uri = None, None
        for batch in batches:
            lines, sizes = [], []
            for file, offset in zip(batch.column("_file").to_pylist(), batch.column("_offset").to_pylist()):
                if file != uri:
                    source, uri = opened(file), file
                line, size = record(source, offset)
                lines.append(line.decode("utf-8", "replace"))
                sizes.append(size)
            columns = [*batch.columns, pa.array(lines, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "line", "_fetched"])

    return rows


def refused_records(errors: DataFrame, fetch_bytes: int = FETCH_BYTES) -> DataFrame:
    """The text of the records ``errors`` stand for: ``line, _source_file, _at, _source_time, _fetched``.

    ``errors`` has the ``_at`` of records read by :func:`csv_records.read_records` (a feed read with
    ``multiline``), so that ``block + seq`` is a byte of the file.  Positions are dealt out in feed
    order: a task opens few files and fetches about ``fetch_bytes`` for each record, whatever the
    size of the feed.  The files have to be as they were.
    """
    order = ["_file", "_offset"]
    places = errors.select(F.col("_at.file").alias("_file"), (F.col("_at.block") + F.col("_at.seq")).alias("_offset"), "_at")
    placed = places.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"_file string, _offset bigint, _at {places.schema['_at'].dataType.simpleString()}, line string, _fetched bigint"
    return placed.mapInArrow(_fetcher(fetch_bytes), schema).select(
        "line", F.col("_file").alias("_source_file"), "_at", F.lit(None).cast("timestamp").alias("_source_time"), "_fetched"
    )
