"""Token ids as flat unsigned integer files with 64-bit document offsets, read by memory map."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from feedgate.llm.common import staged
from feedgate.llm.files import SharedFolder, ship
from feedgate.session import work_dir

#: Characters of text encoded at once, and pieces of a generation; a worker keeps two (about 200 MB).
BATCH_CHARS = 1 << 23
KEPT_PIECES = 1 << 19
#: New pieces of one call of the tokenizer.
TOGETHER = 256
#: Unicode's White_Space, as patterns see it.
BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_BEFORE_BLANK = re.compile(f"[{BLANKS}] ")
_PIECES = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")


class Encoder:
    """Ids of whole texts, equal to the tokenizer's own.

    Byte-level tokenizers cut a text into words before merging, and no word reaches from a visible
    character over following white space.  A text may therefore be cut there and each piece
    encoded alone.  Pieces repeat, so a worker keeps the ids of those it has seen; new ones are
    encoded many at a time between special tokens.  Other tokenizers get each text whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks of a machine
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        setup = json.loads(self.tokenizer.to_str())
        words, added = setup["pre_tokenizer"] or {}, setup["added_tokens"]
        cuttable = (
            words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words["add_prefix_space"]
            and not any(setup[k] for k in ("normalizer", "truncation", "padding"))
            and not any(re.search(f"[{BLANKS}]", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self.mark = next(((t["content"], t["id"]) for t in added if t["special"]), None) if cuttable else None
        # Pieces behind a blank, and others: those met of late, and those met before.
        self.recent: dict[str, dict[str, bytes]] = {" ": {}, "": {}}
        self.older: dict[str, dict[str, bytes]] = {" ": {}, "": {}}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _learn(self, pieces: list[str], into: dict[str, bytes], prefix: str) -> None:
        text, mark = self.mark
        alone = [p for p in pieces if text in prefix + p]
        into.update(zip(alone, self._whole([prefix + p for p in alone])))
        pieces = [p for p in pieces if text not in prefix + p]
        for i in range(0, len(pieces), TOGETHER):
            some = pieces[i : i + TOGETHER]
            ids = np.frombuffer(self._whole([text.join(prefix + p for p in some)])[0], self.dtype)
            ends = np.append(np.nonzero(ids == mark)[0], len(ids))
            starts, data, width = np.append(0, ends[:-1] + 1), ids.tobytes(), self.dtype.itemsize
            into.update(zip(some, (data[a * width : b * width] for a, b in zip(starts.tolist(), ends.tolist()))))

    def _know(self, pieces: set[str], prefix: str) -> None:
        """Have the ids of all pieces among the recent ones; what was not met for long falls out."""
        recent, older = self.recent[prefix], self.older[prefix]
        if len(recent) > KEPT_PIECES:
            self.older[prefix] = older = recent
            self.recent[prefix] = recent = {}
        missing = pieces.difference(recent)
        kept = [p for p in missing if p in older]
        recent.update(zip(kept, map(older.__getitem__, kept)))
        missing.difference_update(kept)
        self._learn(list(missing), recent, prefix)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, in ``dtype``."""
        if self.mark is None:
            return self._whole(texts)
        # Where a blank follows another, pieces are cut one by one; else a text splits at its blanks.
        cut = {i: _PIECES.findall(text) for i, text in enumerate(texts) if _BEFORE_BLANK.search(text)}
        split = [i for i in range(len(texts)) if i not in cut]
        lists = pc.split_pattern(pa.array([texts[i] for i in split], pa.string()), " ")
        words, ends = lists.flatten(), lists.offsets.to_numpy()
        first = ends[:-1]  # words that no blank stands before
        heads = words.take(pa.array(first)).to_pylist()
        coded = words.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        tails = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._know(set(tails), " ")
        self._know(set(heads).union(*cut.values()), "")
        spaced, other = self.recent[" "], self.recent[""]
        # One entry per distinct word behind a blank and per first word; the words' ids in a row.
        entries = pa.array([*map(spaced.__getitem__, tails), *map(other.__getitem__, heads)], pa.binary())
        at[first] = len(tails) + np.arange(len(heads))
        ids = entries.take(pa.array(at))
        borders = np.frombuffer(ids.buffers()[1], np.int32)[ends].tolist() if len(ends) > 1 else [0]
        data = ids.buffers()[2].to_pybytes() if borders[-1] else b""
        out = {i: data[a:b] for i, a, b in zip(split, borders, borders[1:])}
        return [out[i] if i in out else b"".join(map(other.__getitem__, cut[i])) for i in range(len(texts))]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker, so that pieces are kept between tasks."""
    return Encoder(path)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts in groups of about ``BATCH_CHARS``; null texts are empty."""
    ids, texts, chars = [], [], 0
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        texts.append(text.as_py() or "")
        ids.append(doc)
        chars += len(texts[-1])
        if chars >= BATCH_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents' ids in ascending doc_id order; returns the table of parts.

    Documents are range-partitioned and sorted; each partition is one part of three flat files:
    ids with ``end_id`` behind each document (16 bits if the vocabulary allows, else 32), 64-bit
    offsets in the part, and 64-bit doc_ids.  ``first_doc`` and ``first_token`` of a part are prefix
    sums over the table of parts, one small row each.  Files are written under new names and count
    only with their row, so tasks may be run again.

    Null texts are empty, that is only the end id.  Null ids come first (``null_docs`` counts
    them).  Rows may repeat; other columns are ignored; no rows give no parts.
    """
    ship(docs.sparkSession)
    folder = SharedFolder(work_dir(docs.sparkSession, "tokens"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        sizes, owners, nulls = [], [], 0
        with folder.create() as (name, out):
            for batch in batches:
                for ids, texts in _groups(batch):
                    found = encode.encode(texts)
                    out.write(end.join(found) + end)
                    sizes.append(np.fromiter(map(len, found), np.int64, len(found)) // encode.dtype.itemsize + 1)
                    nulls += ids.count(None)
                    owners.append(np.array([0 if i is None else i for i in ids], "<i8"))
        if not sizes:
            return
        offsets = np.append(0, np.cumsum(np.concatenate(sizes)))
        row = {
            "part": TaskContext.get().partitionId(), "ids": name, "ids_type": encode.dtype.str,
            "offsets": folder.save(offsets.astype("<i8")), "doc_ids": folder.save(np.concatenate(owners)),
            "docs": len(offsets) - 1, "null_docs": nulls, "tokens": int(offsets[-1]),
        }
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
            ("part", pa.int32()), ("ids", pa.string()), ("ids_type", pa.string()), ("offsets", pa.string()),
            ("doc_ids", pa.string()), ("docs", pa.int64()), ("null_docs", pa.int64()), ("tokens", pa.int64()),
        ]))

    # The text's hash deals out rows that share an id; equal rows are alike in any order.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_spread", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "_spread").sortWithinPartitions("doc_id", "_spread", "text")
    written = ordered.select("doc_id", "text").mapInArrow(
        rows,
        "part int, ids string, ids_type string, offsets string, doc_ids string, docs bigint, null_docs bigint, tokens bigint",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(written, "token-parts")
    return parts.select(
        F.lit(folder.uri).alias("folder"), "*",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_doc"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first_token"),
    )


def read_tokens(parts: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the mapped files.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian unsigned 32-bit.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                folder = SharedFolder(part["folder"])
                ids = folder.load(part["ids"], part["ids_type"])
                offsets, owners = folder.load(part["offsets"], "<i8"), folder.load(part["doc_ids"], "<i8")
                at = 0
                while at < part["docs"]:
                    # About a million ids, one document at least.
                    upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1)
                    bounds = offsets[at : upto + 1]
                    data = ids[bounds[0] : bounds[-1]].astype("<u4").tobytes()
                    spans = ((bounds - bounds[0]) * 4).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(owners[at:upto], mask=np.arange(at, upto) < part["null_docs"]),
                            pa.array(bounds[:-1] + part["first_token"]),
                            pa.array(np.diff(bounds)),
                            pa.array([data[a:b] for a, b in zip(spans, spans[1:])], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    at = upto

    ship(parts.sparkSession)
    n = max(1, parts.count())
    return parts.repartition(n).mapInArrow(rows, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
