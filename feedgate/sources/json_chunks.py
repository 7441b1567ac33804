"""Cutting large JSON arrays at record borders, in parallel.

The text is read in fragments that end at a comma, so a file splits into byte blocks like any
line-based file and every task sees its block's fragments in order.  Whether a comma ends a record -
an object, an array or a scalar - depends on all text before it: is the place inside a string, and
how deep is it nested?
Two passes over the text answer that without moving it:

1. Every block is summed up in one row: does it flip the inside-a-string state, and by how much
   does it change the depth - for both states it may start in.  Running sums over those rows give
   the state in which each block really starts.
2. Every block is cut at commas outside strings at depth one.  What stands between two cuts is a
   list of whole records and is parsed as a small array of its own; a record that is larger than
   such a list stands alone.  Only the pieces at block borders are put together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedgate.functions.json_fields import elements
from feedgate.session import one_block_a_task, size_setting, work_dir
from feedgate.sources.inventory import GLOBS

#: A record above this size cannot become one variant; it is an error.
MAX_RECORD_BYTES = 64 * 1024 * 1024

#: Records are cut off in lots of about this size.
PACK_BYTES = 64 * 1024

#: Blocks whose starting states are broadcast at once: five numbers each, 20 MB in all.
MAX_BLOCKS = 500_000

MALFORMED = "Malformed JSON document"
OVERSIZED = "JSON record above the size limit"

_KEY = ["file_id", "block"]


def _share(share: tuple[int, int]) -> Column:
    """Files of one share.  The condition needs only the path, so Spark never opens the others."""
    number, of = share
    return F.pmod(F.xxhash64("_metadata.file_path"), F.lit(of)) == number


def _fragments(
    spark: SparkSession, path: str, above_bytes: int, glob: str | None, share: tuple[int, int]
) -> DataFrame:
    """Text between commas, one block of one file in every task, in order."""
    reader = one_block_a_task(spark).read.option("pathGlobFilter", glob or GLOBS["json"]).option("lineSep", ",")
    return (
        reader.text(path)
        .filter((F.col("_metadata.file_size") > above_bytes) & _share(share))
        .select(
            F.xxhash64("_metadata.file_path").alias("file_id"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
            F.monotonically_increasing_id().alias("seq"),
        )
    )


def _headed(fragments: DataFrame, *names: str) -> DataFrame:
    """Only the fragments' text, the first of each task behind the named numbers of its block."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    numbers = F.concat(F.concat_ws(",", *[F.col(n).cast("string") for n in names]), F.lit("\n")).cast("binary")
    return fragments.select(F.when(first, F.concat(numbers, "value")).otherwise(F.col("value")).alias("value"))


def _files(spark: SparkSession, path: str, above_bytes: int, glob: str | None) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob or GLOBS["json"])
        .load(path)
        .filter(F.col("length") > above_bytes)
    )


def shares(
    spark: SparkSession, path: str, above_bytes: int = -1, glob: str | None = None
) -> list[tuple[int, int]]:
    """Shares of the files, each with at most about ``MAX_BLOCKS`` blocks.

    What a share broadcasts is one short row per block or file, so this is its bound.
    """
    block_bytes = size_setting(spark, "spark.sql.files.maxPartitionBytes")
    blocks = (
        _files(spark, path, above_bytes, glob)
        .agg(F.sum(F.ceil(F.col("length") / F.lit(block_bytes))).alias("blocks"))
        .first()
        .blocks
    )
    of = max(1, -(-(blocks or 0) // MAX_BLOCKS))
    return [(number, of) for number in range(of)]


def _scanner(pack_bytes: int, max_bytes: int):
    """The two task-side passes.  Nested, so that they travel by value to the workers."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # Lists of records stay below the limit: what exceeds it is one record.
    pack_bytes = max(1, min(pack_bytes, max_bytes // 4))

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

    def headed(batches):
        """(numbers, texts) per batch: the numbers before the task's first fragment, and the fragments."""
        numbers = None
        for batch in batches:
            values = batch.column(0).cast(pa.binary())
            if not len(values):
                continue
            if numbers is None:
                head, _, first = values[0].as_py().partition(b"\n")
                numbers = [int(n) for n in head.split(b",")]
                values = pa.concat_arrays([pa.array([first], pa.binary()), values.slice(1)])
            yield numbers, values

    def marks(values):
        """Quote parity and bracket steps of the fragments.

        Returns parity after each fragment (from 0), the steps inside each fragment at even and at
        odd parity, and for both the places of closing brackets and the depth behind each.
        """
        offsets = np.frombuffer(values.buffers()[1], np.int32)[
            values.offset : values.offset + len(values) + 1
        ].astype(np.int64)
        body = values.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        ends = offsets[1:] - offsets[0]
        quote = data == 34
        slashes = np.flatnonzero(data == 92)
        if slashes.size:  # a quote after an odd number of backslashes is no border
            last = np.flatnonzero(np.append(np.diff(slashes) != 1, True))
            first = np.append(0, last[:-1] + 1)
            escaped = slashes[last][(last - first) % 2 == 0] + 1
            quote[escaped[escaped < data.size]] = False
        step = ((data == 123) | (data == 91)).astype(np.int8) - ((data == 125) | (data == 93))
        places = np.flatnonzero(quote | (step != 0))
        parity = np.bitwise_xor.accumulate(quote[places].view(np.uint8))
        steps = step[places].astype(np.int64)
        upto = np.searchsorted(places, ends)
        after = np.append(np.uint8(0), parity)[upto]

        def per_fragment(of):
            total = np.append(0, np.cumsum(of))[upto]
            return np.diff(np.append(0, total))

        def closing(side):
            at = np.flatnonzero((parity == side) & (steps < 0))
            return places[at], np.cumsum(steps * (parity == side))[at]

        sides = [per_fragment(steps * (parity == side)) for side in (0, 1)]
        return after, sides, [closing(side) for side in (0, 1)], ends

    def summaries(batches):
        """One row per block: parity flip; from outside / inside: depth change, lowest depth at the
        commas, and behind closing brackets."""
        done = []
        for at, values in headed(batches):
            if not done:
                done.append([*at, 0, 0, 0, *[1 << 40] * 4])
            row = done[-1]
            after, sides, closing, _ = marks(values)
            if row[2]:
                after, sides, closing = after ^ 1, sides[::-1], closing[::-1]
            for start in (0, 1):
                ends_outside = after == start
                shut = closing[start][1]
                if shut.size:
                    row[7 + start] = min(row[7 + start], row[3 + start] + int(shut.min()))
                deep = row[3 + start] + np.cumsum(sides[start])
                row[3 + start] = int(deep[-1])
                if ends_outside.any():
                    row[5 + start] = min(row[5 + start], int(deep[ends_outside].min()))
            row[2] = int(after[-1])
        names = ["file_id", "block", "odd", "from_out", "from_in", "low_out", "low_in", "shut_out", "shut_in"]
        columns = list(zip(*done)) if done else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def pieces(batches):
        """The blocks' text between cuts; ``ended`` is 0 for what is left at a block's end.

        Text behind the end of the array is dropped.
        """
        names = ["file_id", "block", "nth", "ended", "oversized", "lot", "head", "text"]
        key, rest, held, shut = None, [], 0, False  # of the task's one block

        def row(ended):
            text = None if held > max_bytes else text_of(rest)
            return (*key, nth, ended, int(held > max_bytes), lot + (nth > 0), head, text)

        def out(rows):
            columns = list(zip(*rows))
            types = [pa.int64()] * 7 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

        def text_of(parts):
            values = pa.concat_arrays(parts)
            whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pc.binary_join(whole, pa.scalar(b",", pa.binary()))[0].as_py()

        def size_of(values):
            return (pc.sum(pc.binary_length(values)).as_py() or 0) + len(values)

        for numbers, values in headed(batches):
            ready = []
            if key is None:
                *key, inside, depth, lot = numbers
                nth, total, last_lot = 0, 0, -1
                first = values[0].as_py() if key[1] == 0 else b""
                head = (first.lstrip(b" \t\r\n")[:1] or b"\0")[0]
            if shut:
                continue
            after, sides, closing, ends = marks(values)
            ends_outside = (after ^ inside) == 0
            deep = depth + np.cumsum(sides[inside])
            filled = total + np.cumsum(pc.binary_length(values).to_numpy().astype(np.int64) + 1)
            cuts = np.flatnonzero(ends_outside & (deep == 1))
            places, levels = closing[inside]
            closed = np.flatnonzero(depth + levels <= 0)
            if closed.size:  # the array's end: its fragment up to the bracket is the last text
                place = int(places[closed[0]])
                last = int(np.searchsorted(ends, place, side="right"))
                begin = int(ends[last - 1]) if last else 0
                tail = pa.array([values[last].as_py()[: place + 1 - begin]], pa.binary())
                values, cuts, shut = pa.concat_arrays([values.slice(0, last), tail]), cuts[cuts < last], True
            start = 0
            if cuts.size:
                # The first cut of the block, then the first one behind every lot's size; also the
                # last one before a record above that size, which the next batch may bring.
                lots = filled[cuts] // pack_bytes
                chosen = (lots > np.append(last_lot, lots[:-1])) | np.append(np.diff(filled[cuts]) > pack_bytes, True)
                for cut in cuts[chosen].tolist():
                    rest.append(values.slice(start, cut + 1 - start))
                    held += size_of(rest[-1])
                    ready.append(row(1))
                    rest, held, start, nth = [], 0, cut + 1, nth + 1
                last_lot = int(lots[-1])
            if start < len(values):
                held += size_of(values.slice(start))
                rest = [*rest, values.slice(start)] if held <= max_bytes else []
            inside, depth, total = int(after[-1]) ^ inside, int(deep[-1]), int(filled[-1])
            if ready:
                yield out(ready)
        if held:
            yield out([row(0)])

    return summaries, pieces, marks, runs


def _finder(key: str):
    """Task-side search for the value of a key of a document's root object."""
    import json
    import re

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    _, _, marks, runs = _scanner(PACK_BYTES, MAX_RECORD_BYTES)
    name = json.dumps(key, ensure_ascii=False).encode()
    token = re.compile(rb'"(?:[^"\\]|\\.)*"?|[{\[}\]]', re.DOTALL)
    opens = re.compile(rb"\s*:\s*([{\[])")

    def place(text, inside, depth):
        """Where the value of the key opens in a fragment, or None."""
        at = 0
        if inside:
            end = re.compile(rb'(?:[^"\\]|\\.)*"', re.DOTALL).match(text)
            if end is None:
                return None
            at = end.end()
        for m in token.finditer(text, at):
            if m[0] in (b"{", b"["):
                depth += 1
            elif m[0] in (b"}", b"]"):
                depth -= 1
            elif depth == 1 and m[0] == name and (value := opens.match(text, m.end())):
                return value.start(1)
        return None

    def find(batches):
        """The first place in each block."""
        key, found = None, False
        for at, run in runs(batches):
            if at != key:
                key, found = at, False
                inside, depth = (run.column(i)[0].as_py() for i in (4, 5))
            if found:
                continue
            values = run.column(2).cast(pa.binary())
            after, sides, _, _ = marks(values)
            deep = depth + np.cumsum(sides[inside])
            state = after ^ inside
            for i in np.flatnonzero(pc.match_substring(values, name).to_numpy(zero_copy_only=False)).tolist():
                before = (int(state[i - 1]), int(deep[i - 1])) if i else (inside, depth)
                where = place(values[i].as_py(), *before)
                if where is not None:
                    found = True
                    row = [*at, run.column(3)[i].as_py(), where]
                    names = ["file_id", "block", "seq", "where"]
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names=names)
                    break
            inside, depth = int(state[-1]), int(deep[-1])

    return find


def _summed(fragments: DataFrame) -> DataFrame:
    """The state in which every block of the fragments starts."""
    summarise = _scanner(PACK_BYTES, MAX_RECORD_BYTES)[0]
    return _block_starts(
        _headed(fragments, *_KEY).mapInArrow(
            summarise,
            "file_id long, block long, odd long, from_out long, from_in long, "
            "low_out long, low_in long, shut_out long, shut_in long",
        )
    )


def _inside(fragments: DataFrame, key: str) -> DataFrame:
    """The fragments from where the value of a key of the root object opens: a document of its own.

    Two passes over the text, for the blocks' states and for the place; one row per file is kept and
    broadcast, as in ``shares``.  Files without the key have no fragments left.
    """
    spark = fragments.sparkSession
    states = _summed(fragments).select(*_KEY, "inside", "base")
    placed = fragments.join(F.broadcast(states), _KEY).select(*_KEY, "value", "seq", "inside", "base")
    found = placed.mapInArrow(_finder(key), "file_id long, block long, seq long, where long")
    first = found.groupBy("file_id").agg(F.min(F.struct("block", "seq", "where")).alias("open"))
    path = work_dir(spark, "json-inside")
    first.write.parquet(path)
    kept = fragments.join(F.broadcast(spark.read.parquet(path)), "file_id")
    begins = F.col("block") == F.col("open.block")
    kept = kept.filter((F.col("block") > F.col("open.block")) | (begins & (F.col("seq") >= F.col("open.seq"))))
    trimmed = F.expr("substring(value, cast(open.where as int) + 1)")
    return kept.select(
        "file_id", F.when(begins, F.lit(0)).otherwise(F.col("block")).cast("bigint").alias("block"),
        F.when(begins & (F.col("seq") == F.col("open.seq")), trimmed).otherwise(F.col("value")).alias("value"), "seq",
    )


def _before(value: str) -> Column:
    earlier = (
        Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def _block_starts(summaries: DataFrame) -> DataFrame:
    """State in which every block starts, and the number of the lot that reaches into it.

    One row per block, 128 MB of text each by default: 800,000 rows for 100 TB.
    """
    from_outside = F.col("inside") == 0
    sided = summaries.withColumn("inside", _before("odd") % 2).withColumns(
        {
            "step": F.when(from_outside, F.col("from_out")).otherwise(F.col("from_in")),
            "low": F.when(from_outside, F.col("low_out")).otherwise(F.col("low_in")),
            "shut": F.when(from_outside, F.col("shut_out")).otherwise(F.col("shut_in")),
        }
    )
    # Records end at depth one, the lowest a comma of a complete array stands at.
    based = sided.withColumn("base", _before("step")).withColumns(
        {
            "cut": (F.col("base") + F.col("low") <= 1).cast("int"),
            "closes": (F.col("base") + F.col("shut") <= 0).cast("int"),
        }
    )
    starts = based.select(
        *_KEY, "inside", "base", _before("cut").alias("lot"), _before("closes").alias("closed")
    )
    return starts.filter("closed = 0").drop("closed")  # what follows the array is not read


def read_chunks(
    spark: SparkSession,
    path: str,
    above_bytes: int = -1,
    glob: str | None = None,
    share: tuple[int, int] = (0, 1),
    pack_bytes: int = PACK_BYTES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    inside: tuple[str, ...] = (),
) -> DataFrame:
    """Lots of whole records as raw text, of one share of the documents above a size.

    With ``inside`` the records are those of the array at that path of keys, whatever stands around it.

    Columns ``_source_file, _source_time, block, seq, ended, head, text``.  In a complete document
    exactly one chunk, the last record with the closing bracket, has ``ended = 0``.  ``text`` is
    NULL for a record that is too long.  ``head`` of the first chunk is the document's first byte
    that is no white space, or 0.
    """
    _, cut, _, _ = _scanner(pack_bytes, max_record_bytes)
    fragments = _fragments(spark, path, above_bytes, glob, share)
    for key in inside:
        fragments = _inside(fragments, key)
    starts = _summed(fragments)
    # Broadcast, as the fragments of a block must stay together and in order.  See ``shares``.
    placed = _headed(fragments.join(F.broadcast(starts), _KEY), *_KEY, "inside", "base", "lot")
    pieces = placed.mapInArrow(
        cut,
        "file_id long, block long, nth long, ended long, oversized long, lot long, head long, text binary",
    ).withColumn("text", F.col("text").cast("string"))
    # Written, as whole lots and those over block borders both start from it: the text is cut once.
    written = work_dir(spark, "json-pieces")
    pieces.write.parquet(written)
    pieces = spark.read.parquet(written)
    files = (
        _files(spark, path, above_bytes, glob)
        .filter(_share(share))
        .select(
            F.xxhash64("_metadata.file_path").alias("file_id"),
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("modificationTime").alias("_source_time"),
        )
    )
    # Broadcast for the same reason, bounded by ``shares``, as one file may hold most of the text.
    return (
        _joined_borders(pieces, max_record_bytes)
        .join(F.broadcast(files), "file_id")
        .select("_source_file", "_source_time", "block", F.col("nth").alias("seq"), "ended", "head", "text")
    )


def _joined_borders(pieces: DataFrame, max_record_bytes: int) -> DataFrame:
    """Put together the pieces of lots that reach over block borders."""
    inner = (F.col("nth") > 0) & (F.col("ended") == 1)
    whole = pieces.filter(inner).select("file_id", "block", "nth", "ended", "head", "text")
    # Size first, text second: text without a record border could be as long as the file.
    in_lot = Window.partitionBy("file_id", "lot")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(in_lot)
    sized = pieces.filter(~inner).withColumn("size", size)
    fits = (F.col("size") <= max_record_bytes) & (F.col("oversized") == 0)
    kept = F.when(fits, F.col("text")).alias("text")
    merged = (
        sized.groupBy("file_id", "lot")
        .agg(
            F.max("ended").alias("ended"),
            F.bool_and(fits).alias("fits"),
            F.sort_array(F.collect_list(F.struct("block", "nth", "head", kept))).alias("parts"),
        )
        .select(
            "file_id",
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["nth"].alias("nth"),
            "ended",
            F.col("parts")[0]["head"].alias("head"),
            F.when(F.col("fits"), F.array_join(F.col("parts")["text"], ",")).alias("text"),
        )
    )
    return whole.unionByName(merged)


def staged_chunks(
    spark: SparkSession,
    path: str,
    above_bytes: int = -1,
    glob: str | None = None,
    pack_bytes: int = PACK_BYTES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    inside: tuple[str, ...] = (),
) -> DataFrame:
    """The chunks of all documents above a size, written once below the work folder.

    Whatever starts from here - finding the broken documents, parsing, writing parts - reads the
    pieces and not the documents, which are read twice in all: for the blocks' sums and to be cut.
    """
    out = work_dir(spark, "json-chunks")
    for share in shares(spark, path, above_bytes, glob):
        chunks = read_chunks(spark, path, above_bytes, glob, share, pack_bytes, max_record_bytes, inside)
        chunks.write.mode("append").parquet(out)
    return spark.read.parquet(out)


def other_documents(chunks: DataFrame) -> list[str]:
    """Files whose document is no array: a single record, or malformed.  Their names only."""
    first = (F.col("block") == 0) & (F.col("seq") == 0)
    found = chunks.filter(first & ~F.col("head").isin(0, ord("["))).select("_source_file")
    return sorted(r._source_file for r in found.toLocalIterator())


def arrays_only(chunks: DataFrame, others: list[str]) -> DataFrame:
    return chunks.filter(~F.col("_source_file").isin(others)) if others else chunks


def element_text(chunks: DataFrame) -> DataFrame:
    """Chunks with ``elements``: their comma-separated elements, exactly as sent.

    NULL where the text around the elements is not that of an array.
    """
    first = (F.col("block") == 0) & (F.col("seq") == 0)
    body = F.when(first, F.regexp_replace("text", r"^\s*+\[", "")).otherwise(F.col("text"))
    # A list of records is not blank; before the closing bracket only that of an empty array is.
    sound = F.when(F.col("ended") == 1, ~body.rlike(r"^\s*+$")).otherwise(first | ~body.rlike(r"^\s*+\]"))
    opened = ~first | F.col("text").rlike(r"^\s*+\[")
    return chunks.withColumn("elements", F.when(opened & sound, body))


def raw_elements(chunks: DataFrame) -> DataFrame:
    """One ``element`` row per chunk of whole arrays that holds any, as sent."""
    inside = F.when(F.col("ended") == 1, F.col("elements")).otherwise(
        F.regexp_replace("elements", r"\s*+\]\s*+$", "")
    )
    checked = element_text(chunks).select("_source_file", "block", "seq", inside.alias("element"))
    return checked.filter(~F.col("element").rlike(r"^\s*+$")).select(
        "_source_file", "block", "seq", F.regexp_replace("element", r"^\s++", "").alias("element")
    )


def parsed_elements(chunks: DataFrame) -> DataFrame:
    """``records``: the parsed elements of each chunk, NULL where it is malformed."""
    wrapped = F.concat(
        F.lit("["), F.col("elements"), F.when(F.col("ended") == 1, "]").otherwise("")
    )
    return chunks.withColumn("records", F.from_json(wrapped, "array<variant>"))


def broken_arrays(chunks: DataFrame, refuse_oversized: bool = True) -> DataFrame:
    """Files with a chunk that cannot be parsed, or cut off before their closing bracket.

    Records that are too long count as such only with ``refuse_oversized``.
    """
    parsed = parsed_elements(element_text(chunks))
    bad = F.col("records").isNull()
    if not refuse_oversized:
        bad &= F.col("text").isNotNull()
    return (
        parsed.groupBy("_source_file")
        .agg(
            F.min("ended").alias("ended"),
            F.count_if(bad).alias("bad"),
            F.max("_source_time").alias("_source_time"),
        )
        .filter("ended = 1 or bad > 0")
        .select("_source_file", "_source_time")
    )


def _malformed(files: DataFrame) -> DataFrame:
    """One error row for each file, in the shape of ``read_json_feed``."""
    return files.select(
        "_source_file",
        F.struct(
            F.col("_source_file").alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            F.lit(0).cast("bigint").alias("seq"),
            F.lit(0).alias("pos"),
        ).alias("_at"),
        "_source_time",
        F.lit(MALFORMED).alias("_doc_error"),
        # NULL, as a path is no JSON text.  A literal NULL would let Spark work out these rows'
        # columns while planning, and fail there on casts that no row may ever reach.
        F.try_parse_json("_source_file").alias("record"),
    )


def without_array(spark: SparkSession, path: str, above_bytes: int, glob: str | None, chunks: DataFrame) -> DataFrame:
    """Error rows for the documents above a size in which no array was found."""
    files = _files(spark, path, above_bytes, glob).select(
        F.col("_metadata.file_path").alias("_source_file"), F.col("modificationTime").alias("_source_time")
    )
    return _malformed(files.join(chunks.select("_source_file").distinct(), "_source_file", "left_anti"))


def records(chunks: DataFrame, refuse_oversized: bool = True) -> DataFrame:
    """Records of written chunks of arrays, in the shape of ``read_json_feed``.

    An array with a malformed chunk gives one error and no records, as if it were parsed whole.
    A record that is too long refuses its array likewise, or is an error by itself.
    """
    spark = chunks.sparkSession
    path = work_dir(spark, "json-broken")
    broken_arrays(chunks, refuse_oversized).write.parquet(path)
    broken = spark.read.parquet(path)  # Spark broadcasts the names if their files are small
    whole = chunks.join(broken.select("_source_file"), "_source_file", "left_anti")
    parsed = (
        elements(
            parsed_elements(element_text(whole)), "_source_file", "block", "seq", "_source_time"
        ).select(
            "_source_file",
            F.struct(F.col("_source_file").alias("file"), "block", "seq", "pos").alias("_at"),
            "_source_time",
            F.lit(None).cast("string").alias("_doc_error"),
            "record",
        )
    )
    failed = _malformed(broken)
    if not refuse_oversized:
        long = whole.filter(F.col("text").isNull())
        failed = failed.unionByName(
            long.select(
                "_source_file",
                F.struct(F.col("_source_file").alias("file"), "block", "seq", F.lit(0).alias("pos")).alias("_at"),
                "_source_time",
                F.lit(OVERSIZED).alias("_doc_error"),
                F.try_parse_json("_source_file").alias("record"),
            )
        )
    return parsed.unionByName(failed)
