"""SimHash near-duplicates: fingerprints, Golay-code keys, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from feedgate.llm import golay
from feedgate.llm.common import staged
from feedgate.llm.components import components, contract
from feedgate.llm.files import ship

#: Fixed values of the fingerprint: words of a shingle, seed of its hash, bits that may differ.
SHINGLE = 3
SEED = 42
DISTANCE = 3
#: First bit of each of the three segments, and the end.
CUTS = (0, 22, 43, 64)
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Nearest-codeword members of one bucket that a task holds; larger buckets are dealt out.
BUCKET = 8192
#: Candidate pairs compared at once, and links kept before they are contracted.
BLOCK = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts, ends = (ends - size).tolist(), ends.tolist()
    ends = ends[shingle - 1 :] or ends[-1:]
    counts = np.zeros(64, dtype=np.int64)
    step = 1 << 16  # shingles at a time, however long the text
    for i in range(0, len(ends), step):
        spans = zip(starts[i : i + step], ends[i : i + step])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(((counts * 2 > len(ends)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) of every row; whole texts, one document at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, fp bigint")


def segments(fps: np.ndarray) -> list[np.ndarray]:
    bits = fps.view(np.uint64)
    return [(bits >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1) for a, b in zip(CUTS, CUTS[1:])]


def keys(fps: np.ndarray, nearest: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket keys of fingerprints, with the row each belongs to and whether it is a nearest one.

    Three or fewer errors leave at least two of three segments with one error at most, so two
    linked fingerprints agree in the codeword indices of some pair of segments: the nearest
    codewords of the one are among the nearby codewords of the other.
    """
    near = [golay.nearby(s) for s in segments(fps)]
    width = 1 if nearest else near[0].shape[1]
    out = []
    for p, (i, j) in enumerate(PAIRS):
        a, b = near[i][:, :width, None], near[j][:, None, :width]
        key = np.where((a < 0) | (b < 0), -1, (p << 2 * golay.DATA) | (a << golay.DATA) | b)
        key = key.reshape(len(fps), -1)
        row, column = np.nonzero(key >= 0)
        out.append((key[row, column], row, column == 0))
    return tuple(np.concatenate(x) for x in zip(*out))


def _buckets(nodes: DataFrame, nearest: bool) -> DataFrame:
    """``key, side, fp``: side 0 where both segments decode to the key's codewords."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for i in range(0, len(fps), 4096):
                key, row, first = keys(fps[i : i + 4096], nearest)
                columns = [key.astype(np.int32), (~first).astype(np.int8), fps[i : i + 4096][row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "side", "fp"])

    return nodes.select("fp").mapInArrow(rows, "key int, side tinyint, fp bigint")


def _linked(distance: int):
    """Task: sorted bucket rows to links of nearby fingerprints, as stars of what it has linked."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[np.ndarray, np.ndarray]] = []
        held, runs, fps = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            bucket, salt, side, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "side", "fp"))
            # Side 0 rows of the bucket that went on at the end of the last batch stand in front.
            run = np.concatenate([runs, (bucket.astype(np.int64) << 32) | salt])
            fp, other = np.concatenate([fps, fp]), np.concatenate([np.zeros(len(fps), bool), side > 0])
            for found in _verified(run, fp, other, distance):
                links.append(found)
                held += len(found[0])
                if held > BLOCK:
                    links = [contract(*map(np.concatenate, zip(*links)))]
                    held = len(links[0][0])
            open_ = (run == run[-1]) & ~other if len(run) else slice(0)
            runs, fps = run[open_], fp[open_]
        if links:
            a, b = contract(*map(np.concatenate, zip(*links)))
            for i in range(0, len(a), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(a[i : i + (1 << 16)]), pa.array(b[i : i + (1 << 16)])], ["a", "b"])

    return rows


def _verified(run, fp, other, distance) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each side 0 row against all later rows of its run, in blocks."""
    if not len(run):
        return
    end = np.searchsorted(run, run, side="right")
    first = np.nonzero(~other & (end - np.arange(len(run)) > 1))[0]
    size = end[first] - first - 1
    total = np.cumsum(size)
    at = 0
    while at < len(first):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, side="right")))
        n = size[at:upto]
        left = np.repeat(first[at:upto], n)
        right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + left + 1
        close = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= distance
        if close.any():
            yield fp[left[close]], fp[right[close]]
        at = upto


def links(nodes: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that connect all fingerprints (``fp``, distinct) within ``distance`` bits.

    Buckets are the Golay keys.  In a bucket each side 0 row is compared with all rows, which
    finds every pair: a fingerprint is side 0 in the buckets of its nearest codewords.  A bucket
    with more side 0 rows than ``bucket`` is dealt to several: its side 0 rows are split, the
    others go to each part.  A task keeps links as stars, so what it returns grows with the
    fingerprints it has linked, not with the pairs.
    """
    ship(nodes.sparkSession)
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"segments and keys are laid out for at most {DISTANCE} differing bits")
    hot = staged(
        _buckets(nodes, True).groupBy("key").count().filter(F.col("count") > bucket)
        .select("key", F.ceil(F.col("count") / bucket).cast("int").alias("parts")),
        "simhash-hot",
    )
    rows = _buckets(nodes, False)
    if hot.isEmpty():
        rows = rows.withColumn("salt", F.lit(0))
    else:
        own = F.pmod(F.hash("fp"), F.coalesce("parts", F.lit(1)))
        parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        rows = (
            rows.join(hot, "key", "left")
            .withColumn("salt", F.explode(parts))
            .withColumn("side", F.when((F.col("side") == 0) & (F.col("salt") == own), 0).otherwise(1).cast("tinyint"))
            .drop("parts")
        )
    spark = nodes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "key", "salt").sortWithinPartitions("key", "salt", "side")
    return dealt.select("key", "salt", "side", "fp").mapInArrow(_linked(distance), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Each row's ``doc_id``, ``fp`` and ``component_id``, the smallest doc_id reachable by links.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into shingles of
    ``shingle`` words, repeats included; fewer words make one shingle.  Null and wordless texts
    have fingerprint 0 and link like any other.  Equal fingerprints are one node, so copies cost
    nothing; a null id is no candidate for component_id, which is null where all ids are.  Rows
    may repeat; other columns are ignored; no rows give no rows.
    """
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(links(nodes, distance)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all columns.

    Rows that share a doc_id are one document: they stay or go together, unless their texts fall
    into different components.  Documents without an id stay where their component has no id.
    """
    kept = near_duplicates(docs, shingle, distance).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
