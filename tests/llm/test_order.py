"""Hilbert shards, fair mixing and token files."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedgate.llm import hilbert, mixing, token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_each_cell_once_step_by_step(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side**dims).select(
        "id", *[(F.floor(F.col("id") / side**d) % side).cast("int").alias(f"x{d}") for d in range(dims)]
    )
    index = hilbert.hilbert_index([F.col(f"x{d}") for d in range(dims)], bits)
    rows = sorted(cells.withColumn("h", index).collect(), key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(side**dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"x{d}"] - b[f"x{d}"]) for d in range(dims)) == 1


def test_levels_follow_row_counts(spark):
    rows = spark.createDataFrame([(i,) for i in [1] * 50 + [2] * 25 + [3] * 25] + [(None,)], "v int")
    assert hilbert.levels(rows, F.col("v"), 2) == [(1, 0), (2, 2), (3, 3)]
    assert hilbert.levels(rows.filter("v > 9"), F.col("v"), 2) == []


def test_shards(awkward, nothing):
    size = F.length(F.coalesce("text", F.lit("")))
    got = hilbert.hilbert_shards(awkward, [F.col("source"), size], [F.col("doc_id"), F.crc32(F.col("text").cast("binary"))], 8)
    assert got.columns == [*awkward.columns, "hilbert", "shard", "slot"]
    assert rows_of(got, *awkward.columns) == rows_of(awkward, *awkward.columns)
    slots = defaultdict(list)
    for r in got.collect():
        slots[r.shard].append((r.slot, r.hilbert))
    assert sorted(slots) == list(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    ends = [[h for _, h in sorted(slots[s])] for s in range(8)]
    assert [s for x in ends for s in x] == sorted(s for x in ends for s in x)
    assert all([s for s, _ in sorted(x)] == list(range(len(x))) for x in slots.values())
    ranges = hilbert.shard_ranges(got, ["source"])
    assert ranges.count() == 8 and ranges.agg(F.sum("rows")).first()[0] == awkward.count()
    assert hilbert.hilbert_shards(nothing, [F.col("source")], [F.col("doc_id")], 8).count() == 0


def plain_targets(sizes, weights=(5, 2, 1)):
    """Sources share the budget by weight; who is above its cap stops, and what is over is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix(awkward):
    entries = awkward.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), "_key")
    mix = mixing.fair_mix(entries)
    rows = mix.entries.collect()
    sizes = Counter()
    for r in awkward.collect():
        sizes[r.source] += len(re.findall("[^ \t-\r]+", r.text or ""))
    targets = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.copies in (0, 1, 2)
        taken[r.source] += r.copies * r["size"]
    largest = max(r["size"] for r in rows)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * largest
    assert len(rows) == awkward.count() and "_key" in mix.entries.columns
    again = mixing.fair_mix(entries.repartition(3)).entries
    assert rows_of(again, "doc_id", "size", "copies") == rows_of(mix.entries, "doc_id", "size", "copies")
    stream = mix.stream.orderBy("position").collect()
    assert sum(r["size"] for r in stream) <= sum(targets.values())
    within = Counter()
    for r in stream:  # a queue is served in its own order, all copies one after the other
        if r["size"]:
            within[r.source] += 1
    assert set(within) <= set(sizes)


def test_mix_against_one_queue(spark):
    """The cut equals that of one list sorted by finish time."""
    docs = [(i, f"s{i % 4}" if i % 9 else None, 1 + (i * 37) % 23) for i in range(500)]
    frame = spark.createDataFrame(docs, "doc_id bigint, source string, size bigint")
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    targets, upto, copies = plain_targets(sizes), Counter(), []
    rank = {s: k for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    for i, s, n in sorted(docs, key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()):
        upto[s] += n
        copies += [((c * sizes[s] + upto[s]) / targets[s], rank[s], c, i, n) for c in range(2)]
    left, taken = sum(targets.values()), Counter()
    for _, _, _, i, n in sorted(copies):
        left -= n
        if left < 0:
            break
        taken[i] += 1
    got = mixing.fair_mix(frame).entries.collect()
    assert {r.doc_id: r.copies for r in got} == {i: taken[i] for i, _, _ in docs}


def test_mixed_documents(awkward, nothing):
    got = mixing.mixed_documents(awkward)
    assert got.columns == awkward.columns
    repeated = Counter(rows_of(got, *got.columns))
    assert set(repeated) <= set(rows_of(awkward, *awkward.columns)) and max(repeated.values()) > 1
    assert all((r.text or "").split() for r in got.collect())
    assert mixing.mixed_documents(nothing).count() == 0
    wordless = awkward.filter("text is null or trim(text) = ''")
    assert mixing.mixed_documents(wordless).count() == 0


def test_tokens(awkward, nothing):
    tokenizer = Tokenizer.from_file(BPE)
    parts = token_files.write_tokens(awkward, BPE)
    got = sorted(token_files.read_tokens(parts).collect(), key=lambda r: r.start)
    assert [r.doc_id is None for r in got] == sorted((r.doc_id is None for r in got), reverse=True)
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids)
    want = Counter()
    for r in awkward.collect():
        found = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id, zlib.crc32(np.array(found, "<u4").tobytes()), len(found)] += 1
    assert Counter((r.doc_id, zlib.crc32(r.ids), r.n_tokens) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert parts.agg(F.sum("tokens")).first()[0] == at
    assert token_files.read_tokens(token_files.write_tokens(nothing, BPE)).count() == 0


TRICKY = [
    "a  b", " lead", "trail ", "x\n\n y \n z", "<|endoftext|> hi<|endoftext|>", "a\u00a0 b", "don't 'll  \t\tx", "",
    "   ", "Th\u00e9 quick\u3000 brown", "a\x1c b", "1 22  333", "\u2028 x",
]


def test_pieces_are_encoded_as_in_the_text():
    encoder = token_files.Encoder(BPE)
    rng = np.random.default_rng(4)
    signs = ["a", "th", " ", " ", ".", "\u0153", "\u00aa", "_", "]", "\n", "\u00e9", "'s", "1", "!", "\u00a0", "\x1c", "<|endoftext|>", "Zb", "\t"]
    texts = TRICKY + ["".join(rng.choice(signs, 25)) for _ in range(2000)]
    want = [np.array(x.ids, encoder.dtype).tobytes() for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want
    other = token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.mark is None
    want = [np.array(x.ids, other.dtype).tobytes() for x in other.tokenizer.encode_batch(TRICKY, add_special_tokens=False)]
    assert other.encode(TRICKY) == want


def test_a_hot_id_fills_many_parts(spark):
    """Rows of one id, and rows without, are dealt out by their text; order and counts stay."""
    rows = [(5, f"text number {i}") for i in range(3000)] + [(None, f"none {i}") for i in range(600)] + [(i, f"t{i}") for i in range(100, 200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts stay apart here
    try:
        parts = token_files.write_tokens(docs, BPE)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.docs for r in parts.collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 1500
    read = token_files.read_tokens(parts).orderBy("start").collect()
    ids = [r.doc_id for r in read]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in read] == [0, *np.cumsum([r.n_tokens for r in read])[:-1].tolist()]
