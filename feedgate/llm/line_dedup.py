"""Lines that repeat across documents, found by probing a sharded minimal perfect hash."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feedgate.llm import mph
from feedgate.llm.common import staged
from feedgate.llm.files import SharedFolder, ship
from feedgate.llm.words import slices
from feedgate.session import work_dir

SPACES = " \t\n\x0b\f\r"
#: Code points of a key from which its line counts, and documents from which it repeats.
MIN_CHARS = 40
MIN_DOCS = 5
#: Keys of one shard: about 18 MB of arrays.
SHARD_KEYS = 1 << 20
#: Shards a task keeps open.
OPEN_SHARDS = 64
#: Characters of text whose lines are probed together, in the order of the shards.
PROBE_CHARS = 1 << 23
#: Flat arrays of a shard, one behind the other in its file: per key its largest id, count of
#: documents and fingerprint; words of bits, their ranks and level sizes of the hash.
ARRAYS = {"keepers": "<i8", "words": "<u8", "ranks": "<i8", "sizes": "<i8", "docs": "<u4", "prints": "<u4"}
#: Stands for a null doc_id, which is smaller than any other.
NO_ID = -(1 << 63)


def key_of(line: str, min_chars: int) -> bytes | None:
    """128-bit digest of a line's key; None if the key is too short to count."""
    key = line.strip(SPACES)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """``high, low, doc_id`` once for each row and distinct key in it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests: list[bytes] = []
            owners: list[int] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = {key_of(x, min_chars) for x in (text or "").split("\n")} - {None}
                digests += found
                owners += [NO_ID if doc is None else doc] * len(found)
            high, low = _halves(digests)
            columns = [high.view(np.int64), low.view(np.int64), np.array(owners, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["high", "low", "doc_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rows, "high bigint, low bigint, doc_id bigint"
    )


def build_index(docs: DataFrame, folder: SharedFolder, min_chars: int, shard_keys: int) -> list[dict]:
    """Write a file of arrays per shard, over all distinct keys; returns one row per shard.

    Pairs of key and document are made distinct first, so a repeated row counts once; counts then
    combine per task, so a line in every document is one row per task.
    """
    counted = line_keys(docs, min_chars).distinct().groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper")
    )
    counted = staged(counted, "line-counts")
    shards = max(1, -(-counted.count() // shard_keys))

    def save(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        high, low, docs_, keeper = (group.column(c).to_numpy() for c in ("high", "low", "docs", "keeper"))
        high, low = high.view(np.uint64), low.view(np.uint64)
        arrays = mph.build(high, low)
        order = np.argsort(mph.probe(arrays, high, low))
        arrays |= {
            "prints": _print(high[order], low[order]),
            "docs": np.minimum(docs_[order], (1 << 32) - 1),
            "keepers": keeper[order],
        }
        data = b"".join(arrays[n].astype(kind).tobytes() for n, kind in ARRAYS.items())
        lengths = {n: [len(arrays[n])] for n in ARRAYS}
        name = folder.save(np.frombuffer(data, np.uint8))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "name": [name], **lengths})

    schema = "shard int, name string, " + ", ".join(f"{n} bigint" for n in ARRAYS)
    shard = F.pmod("high", F.lit(shards)).cast("int")
    built = counted.withColumn("shard", shard).groupBy("shard").applyInArrow(save, schema)
    # One row per million distinct lines.
    return [{"shards": shards}, *(r.asDict() for r in staged(built, "line-shards").collect())]


def _print(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high ^ mph.mix(low)) & np.uint64((1 << 32) - 1)


class _Shards:
    """The index as a task sees it: maps of the shards it has probed last."""

    def __init__(self, folder: SharedFolder, index: list[dict]):
        self.folder, self.shards = folder, index[0]["shards"]
        self.rows = {r["shard"]: r for r in index[1:]}
        self.open: OrderedDict[int, dict] = OrderedDict()
        self.opened = 0

    def _arrays(self, shard: int) -> dict | None:
        if shard not in self.open:
            row, arrays, at = self.rows.get(shard), {}, 0
            if row:
                data = self.folder.load(row["name"], "u1")
                for n, kind in ARRAYS.items():
                    end = at + row[n] * np.dtype(kind).itemsize
                    arrays[n], at = data[at:end].view(kind), end
            self.open[shard] = arrays
            self.opened += 1
            if len(self.open) > OPEN_SHARDS:
                self.open.popitem(last=False)
        self.open.move_to_end(shard)
        return self.open[shard]

    def keepers(self, high: np.ndarray, low: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key stands in ``min_docs`` documents, and the largest id that holds it."""
        repeats, keeper = np.zeros(len(high), bool), np.zeros(len(high), np.int64)
        shard = (high.view(np.int64) % np.int64(self.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        for rows in np.split(order, np.nonzero(np.diff(shard[order]))[0] + 1):
            arrays = len(rows) and self._arrays(int(shard[rows[0]]))
            if not arrays:
                continue
            at = mph.probe(arrays, high[rows], low[rows])
            rows, at = rows[at >= 0], at[at >= 0]
            same = arrays["prints"][at] == _print(high[rows], low[rows])
            rows, at = rows[same], at[same]
            repeats[rows] = arrays["docs"][at] >= min_docs
            keeper[rows] = arrays["keepers"][at]
        return repeats, keeper


def _slabs(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Slices of neighbouring rows with about ``chars`` characters of text, one row at least."""
    for batch in batches:
        ends = np.cumsum(np.nan_to_num(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chars, side="right"))
            upto = max(at + 1, upto)
            yield batch.slice(at, upto - at)
            at = upto


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS
) -> DataFrame:
    """All rows and columns of ``docs`` without repeated lines, plus ``n_lines`` and ``n_dropped``.

    A text is split at newlines; a line's key is the line without white space (ASCII) at its ends
    and with A-Z lower-cased.  A key of ``min_chars`` code points or more that ``min_docs`` documents
    hold loses all its lines but those of the largest doc_id that holds it; the others stay, in
    order.  Keys are 128-bit digests.  All distinct ones go into shards of a minimal perfect hash with
    arrays of fingerprints, counts of documents and keepers, a file for each in the shared folder that
    tasks map and probe: lines are never joined, and the count a probe finds decides.

    Null and empty texts are one empty line, and stay as they are.  Rows that share a doc_id are one
    document, and rows of the keeping id all keep the line; rows without an id are one document,
    with the smallest id.  A column of ``docs`` named n_lines or n_dropped is replaced.  No rows
    give no rows.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    folder = SharedFolder(work_dir(spark, "line-index"))
    index = build_index(docs, folder, min_chars, shard_keys)
    own = [f for f in docs.schema if f.name not in ("n_lines", "n_dropped")]
    schema = T.StructType([*own, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(folder, index)
        for batch in _slabs(batches, PROBE_CHARS):
            ids = [NO_ID if d is None else d for d in batch.column("doc_id").to_pylist()]
            texts = [t if t is None else t.split("\n") for t in batch.column("text").to_pylist()]
            where, digests = [], []
            for row, lines in enumerate(texts):
                for i, line in enumerate(lines or ()):
                    if (digest := key_of(line, min_chars)) is not None:
                        where.append((row, i))
                        digests.append(digest)
            repeats, keeper = shards.keepers(*_halves(digests), min_docs)
            dropped = [0] * len(ids)
            for k in np.nonzero(repeats)[0].tolist():
                row, i = where[k]
                if ids[row] != keeper[k]:
                    texts[row][i] = None
                    dropped[row] += 1
            columns = {f.name: batch.column(f.name) for f in own}
            columns["text"] = pa.array(
                [t and "\n".join(x for x in t if x is not None) for t in texts], batch.column("text").type
            )
            columns["n_lines"] = pa.array([len(t) if t else 1 for t in texts], pa.int64())
            columns["n_dropped"] = pa.array(dropped, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select(*[F.col(f"`{f.name}`") for f in own]).mapInArrow(rows, schema)
