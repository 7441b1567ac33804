"""CSV records whose quoted cells may hold line breaks, cut in parallel.

The text is read line by line in byte blocks.  Whether a line end ends a record depends on how many
quotes stand before it in the file: it does where their number is even.  (A doubled quote inside a
cell counts as two and changes nothing.)  Two passes answer that without moving the text:

1. Every block is summed up in one row: does it flip the parity of quotes, how many bytes has it,
   and where do its first and last records begin and end, for both parities it may start with.
   Running sums over those rows give the parity and the byte offset at which each block starts.
2. Lines between a block's first and last record end are joined to records where they are.  Only
   the lines of records that reach over block borders are put together by a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedgate.session import block_session, size_setting, work_dir
from feedgate.sources.inventory import GLOBS, FeedError

#: A record above this size that reaches over a block border is taken for a quote left open.
MAX_RECORD_BYTES = 64 * 1024 * 1024

#: Blocks whose starting states are broadcast at once: nine numbers each, 40 MB in all.
MAX_BLOCKS = 500_000

_KEY = ["file_id", "block"]


def _lines(session: SparkSession, path: str, glob: str | None) -> DataFrame:
    """Physical lines with their place; files go by the hash of their path."""
    reader = session.read.option("pathGlobFilter", glob or GLOBS["csv"]).option("lineSep", "\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return reader.text(path).select(
        F.xxhash64("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        (quotes % 2).cast("tinyint").alias("odd"),
        (F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        is_blank(F.col("value")).cast("tinyint").alias("blank"),
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_time"),
    )


def _passes():
    """The two task-side passes.  Nested, so that they travel by value to the workers."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def runs(batches):
        """(key, batch) per stretch of one block; a block's batches follow each other."""
        for batch in batches:
            ids, blocks = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(ids):
                continue
            change = np.flatnonzero((ids[1:] != ids[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            edges = [0, *change.tolist(), len(ids)]
            for start, stop in zip(edges, edges[1:]):
                yield (int(ids[start]), int(blocks[start])), batch.slice(start, stop - start)

    def summaries(batches):
        """One row per block: parity, bytes, bytes before the first line that is not blank, the first line
        that flips the parity and the bytes up to it, and the last line with even / odd quotes up to
        it and the bytes up to it."""
        done, key = [], None
        for at, run in runs(batches):
            seq, odd, size, blank = (run.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4, 5))
            if at != key:
                done.append([*at, 0, 0, -1, -1, 0, -1, 0, -1, 0])
                key = at
            row = done[-1]
            parity = (row[2] + np.cumsum(odd)) & 1
            upto = row[3] + np.cumsum(size)
            filled = np.flatnonzero(blank == 0)
            if row[4] < 0 and filled.size:
                row[4] = int(upto[filled[0]] - size[filled[0]])
            flips = np.flatnonzero(odd)
            if row[5] < 0 and flips.size:
                row[5], row[6] = int(seq[flips[0]]), int(upto[flips[0]])
            for start in (0, 1):
                ends = np.flatnonzero(parity == start)
                if ends.size:
                    row[7 + 2 * start], row[8 + 2 * start] = int(seq[ends[-1]]), int(upto[ends[-1]])
            row[2], row[3] = int(parity[-1]), int(upto[-1])
        names = ["file_id", "block", "odd", "bytes", "head", "flip", "flip_bytes", "even", "even_bytes", "uneven", "uneven_bytes"]
        columns = list(zip(*done)) if done else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def joined(batches):
        """Lines of whole records, joined; a record has the place of its first line."""
        names = ["block", "seq", "offset", "bytes", "line", "_source_file", "_source_time", "header"]
        key, parity, at_byte, rest = None, 0, 0, None
        for at, run in runs(batches):
            if at != key:
                key, parity, rest = at, 0, None
                at_byte = run.column(8)[0].as_py()
            if rest is not None:  # lines of the record that goes on
                run = pa.Table.from_batches([rest, run]).combine_chunks().to_batches()[0]
            odd, size = (run.column(i).to_numpy().astype(np.int64) for i in (3, 4))
            ends = np.flatnonzero((np.cumsum(odd) & 1) == 0) + 1
            upto = int(ends[-1]) if ends.size else 0
            rest = run.slice(upto) if upto < run.num_rows else None
            if not upto:
                continue
            starts = np.append(0, ends[:-1])
            behind = at_byte + np.cumsum(size)
            offsets = behind[starts] - size[starts]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), run.column(5).slice(0, upto))
            first = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    run.column(1).take(first), run.column(2).take(first), pa.array(offsets),
                    pa.array(behind[ends - 1] - offsets), pc.binary_join(lists, "\n"),
                    *(run.column(i).take(first) for i in (6, 7, 9)),
                ],
                names=names,
            )
            at_byte = int(behind[upto - 1])

    return summaries, joined


def _starts(lines: DataFrame) -> DataFrame:
    """What each block starts with: parity, byte offset, where its first record begins and the last ends.

    One row per block, 128 MB of text each by default: 800,000 rows for 100 TB.
    """
    summarise, _ = _passes()
    numbers = "file_id, block, odd, bytes, head, flip, flip_bytes, even, even_bytes, uneven, uneven_bytes"
    sums = lines.select("file_id", "block", "seq", "odd", "bytes", "blank").mapInArrow(
        summarise, ", ".join(f"{n} long" for n in numbers.split(", "))
    )
    earlier = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    sided = sums.withColumn("inside", inside).withColumn("offset", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
    within = F.col("inside") == 1
    # A block that starts inside a cell and closes it nowhere belongs to one record with all its lines.
    middle = within & (F.col("flip") < 0)
    known = sided.withColumns(
        {
            "lead": F.when(middle, F.lit((1 << 63) - 1)).when(within, F.col("flip")).otherwise(F.lit(-1)),
            "lead_bytes": F.when(middle, F.col("bytes")).when(within, F.col("flip_bytes")).otherwise(F.lit(0)),
            "last": F.when(middle, F.lit(-1)).when(within, F.col("uneven")).otherwise(F.col("even")),
            "last_bytes": F.when(middle, F.col("bytes")).when(within, F.col("uneven_bytes")).otherwise(F.col("even_bytes")),
        }
    )
    # The block in which the record begins that reaches into this one.
    begins = F.when(~middle & (F.col("last_bytes") < F.col("bytes")), F.col("block"))
    # The header: the first line of the file that is not blank.
    filled = F.when(F.col("head") >= 0, F.col("offset") + F.col("head"))
    known = known.withColumn("header", F.min(filled).over(Window.partitionBy("file_id")))
    return known.withColumn("chain", F.max(begins).over(earlier)).select(
        *_KEY, "odd", "bytes", "header", "offset", "lead", "lead_bytes", "last", "last_bytes", "chain"
    )


def _require_closed(starts: DataFrame, max_record_bytes: int) -> None:
    """Refuse a feed in which a cell stays open for too long, before its text is put together."""
    into = starts.filter("lead_bytes > 0").select("file_id", "chain", F.col("lead_bytes").alias("part"))
    out = starts.filter("lead < 9223372036854775807 and last_bytes < bytes").select(
        "file_id", F.col("block").alias("chain"), (F.col("bytes") - F.col("last_bytes")).alias("part")
    )
    sizes = into.unionByName(out).groupBy("file_id", "chain").agg(F.sum("part").alias("bytes"))
    if not sizes.filter(F.col("bytes") > max_record_bytes).isEmpty():
        raise FeedError(f"a quoted cell does not close within {max_record_bytes} bytes")


def read_records(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    block_bytes: int | None = None,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> DataFrame:
    """All records of CSV files as raw text, the header line of each file among them.

    Columns ``line, _source_file, _source_time, _at, _offset, _bytes, _first``: the place in the feed
    (``block`` and ``seq`` add up to the byte offset of the record in its file, which ``_offset`` is),
    its bytes with the line end, and whether it is the first of its file.  Records end at ``\\n`` or ``\\r\\n`` outside quotes; inside them line breaks
    stay as they are.  Blank records are left out.  Blocks have ``block_bytes``, by default the
    session's split size, whatever the cluster: both passes see the same ones.
    """
    block_bytes = block_bytes or size_setting(spark, "spark.sql.files.maxPartitionBytes")
    lines = _lines(block_session(spark, block_bytes), path, glob)
    place = work_dir(spark, "csv-blocks")
    _starts(lines).write.parquet(place)
    starts = spark.read.parquet(place)
    _require_closed(starts, max_record_bytes)
    shares = max(1, -(-starts.count() // MAX_BLOCKS))
    mine = [F.pmod(F.col("file_id"), F.lit(shares)) == number for number in range(shares)]
    return reduce(DataFrame.unionByName, [_records(lines.filter(m), starts.filter(m)) for m in mine])


def _records(lines: DataFrame, starts: DataFrame) -> DataFrame:
    # Broadcast, as the lines of a block must stay together and in order; bounded by MAX_BLOCKS.
    states = starts.select(*_KEY, "header", "offset", "lead", "lead_bytes", "last", "last_bytes", "chain")
    placed = lines.join(F.broadcast(states), _KEY, "left")
    # Blocks are cut alike in both passes; a feed that changed in between must not lose rows.
    changed = F.raise_error(F.lit("the feed changed while it was read")).cast("boolean")
    known = F.when(F.col("lead").isNull(), changed).otherwise(F.lit(True))
    leading = F.col("seq") <= F.col("lead")
    whole = ~leading & (F.col("seq") <= F.col("last"))

    _, join = _passes()
    begin = (F.col("offset") + F.col("lead_bytes")).alias("begin")
    inner = placed.filter(known & whole).select(
        *_KEY, "seq", "odd", "bytes", "value", "_source_file", "_source_time", begin, "header"
    )
    inner = inner.mapInArrow(
        join,
        "block long, seq long, offset long, bytes long, line string, _source_file string, _source_time timestamp, header long",
    )
    chain = F.when(leading, F.col("chain")).otherwise(F.col("block"))
    start = F.when(leading, None).otherwise(F.col("offset") + F.col("last_bytes"))
    parts = F.sort_array(F.collect_list(F.struct("block", "seq", "value")))
    border = (
        placed.filter(known & ~whole)
        .groupBy("_source_file", "_source_time", chain.alias("chain"))
        .agg(parts.alias("parts"), F.min(start).alias("offset"), F.sum("bytes").alias("bytes"), F.min("header").alias("header"))
        .select(
            F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["seq"].alias("seq"), "offset", "bytes",
            F.array_join("parts.value", "\n").alias("line"), "_source_file", "_source_time", "header",
        )
    )
    line = F.when(F.endswith("line", F.lit("\r")), F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    # The byte in the block: with the block's start it is the byte in the file.
    byte = (F.col("offset") - F.col("block")).alias("seq")
    at = F.struct(F.col("_source_file").alias("file"), "block", byte, F.lit(0).alias("pos"))
    found = inner.unionByName(border).select(
        line.alias("line"), "_source_file", "_source_time", at.alias("_at"),
        F.col("offset").alias("_offset"), F.col("bytes").alias("_bytes"), (F.col("offset") == F.col("header")).alias("_first"),
    )
    return found.filter(~is_blank(F.col("line")))


def is_blank(line: Column) -> Column:
    return line.rlike(r"^[\s\p{Z}]*$")
