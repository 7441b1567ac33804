"""Exact dedup and line dedup against brute force, with awkward rows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
from llm.conftest import rows_of

from feedgate.llm import exact_dedup, line_dedup, mph


def plain(text):
    return re.sub("[ \t-\r]+", " ", text or "")


def test_exact_groups(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append(i)
    want = []
    for i, t in rows:
        ids = groups[plain(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(plain(t).encode()).hexdigest()))
    got = exact_dedup.exact_groups(awkward)
    assert rows_of(got, *got.columns) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_exact_groups_one_salt_or_many(awkward):
    columns = ["doc_id", "keep_id", "group_size"]
    assert rows_of(exact_dedup.exact_groups(awkward, 1), *columns) == rows_of(exact_dedup.exact_groups(awkward, 64), *columns)


def test_drop_copies_keeps_columns(awkward, nothing):
    kept = exact_dedup.drop_copies(awkward)
    assert kept.columns == awkward.columns
    texts = [plain(r.text) for r in kept.collect()]
    assert set(texts) == {plain(r.text) for r in awkward.collect() if r.doc_id is not None} | {
        plain(r.text) for r in kept.collect()
    }
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.drop_copies(nothing).count() == 0


def brute_lines(rows, min_docs, min_chars):
    def key(line):
        k = line.strip(" \t\n\x0b\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k) if len(k) >= min_chars else None

    docs = defaultdict(set)  # documents, not rows
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            docs[k].add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(docs.get(key(x), ())) < min_docs or max(docs[key(x)]) == (-1 if i is None else i)]
        out.append((i, "\n".join(kept) if text is not None else None, len(lines), len(lines) - len(kept)))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_lines(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for min_docs, min_chars, shard_keys in ((5, 40, 1 << 20), (2, 3, 7)):
        got = line_dedup.drop_repeated_lines(awkward, min_docs, min_chars, shard_keys)
        assert rows_of(got, "doc_id", "text", "n_lines", "n_dropped") == brute_lines(rows, min_docs, min_chars)
        assert got.columns == [*awkward.columns, "n_lines", "n_dropped"]
    assert sum(r.n_dropped for r in line_dedup.drop_repeated_lines(awkward).collect()) > 10


def test_rows_of_one_document_count_once(spark):
    """Five rows, three documents: the line stays; with two more documents it goes."""
    line = "one line of forty characters or some more of them"
    rows = [(1, f"{line}\n{i}") for i in range(3)] + [(2, line), (3, line)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sum(r.n_dropped for r in line_dedup.drop_repeated_lines(frame).collect()) == 0
    more = frame.union(spark.createDataFrame([(4, line), (5, line)], frame.schema))
    assert rows_of(line_dedup.drop_repeated_lines(more), "doc_id", "text", "n_lines", "n_dropped") == brute_lines(
        [(r.doc_id, r.text) for r in more.collect()], 5, 40
    )
    assert sum(r.n_dropped for r in line_dedup.drop_repeated_lines(more).collect()) == 6


def test_every_distinct_line_is_indexed(spark, tmp_path):
    """The count array tells lines that repeat from others; a shard is opened once per slab."""
    lines = [f"line number {i} of a text that is long enough to count" for i in range(500)]
    frame = spark.createDataFrame([(i, "\n".join(lines[: 100 * (i + 1)])) for i in range(5)], "doc_id bigint, text string")
    folder = line_dedup.SharedFolder(str(tmp_path))
    index = line_dedup.build_index(frame, folder, 40, 50)
    assert index[0]["shards"] == 10 and sum(r["docs"] for r in index[1:]) == 500
    shards = line_dedup._Shards(folder, index)
    digests = [line_dedup.key_of(x, 40) for x in lines + ["another line that no document has, and no file"]]
    for docs, want in ((5, 100), (1, 500)):
        repeats, keeper = shards.keepers(*line_dedup._halves(digests), docs)
        assert repeats.tolist() == [True] * want + [False] * (501 - want) and set(keeper[:500]) == {4}
    assert shards.opened == 10


def test_lines_of_nothing(nothing):
    assert line_dedup.drop_repeated_lines(nothing).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    high, low = rng.integers(0, 1 << 63, (2, 30_000)).astype(np.uint64)
    low[:100] = low[0]  # halves may repeat, whole keys do not
    arrays = mph.build(high, low)
    assert np.array_equal(np.sort(mph.probe(arrays, high, low)), np.arange(30_000))
    assert arrays["sizes"].sum() < 4 * 30_000
    empty = mph.build(high[:0], low[:0])
    assert (mph.probe(empty, high[:5], low[:5]) == -1).all()
