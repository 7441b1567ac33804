"""Quality scores: hashed word n-gram logistic regression, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from feedgate.llm import words as text_words
from feedgate.llm.common import held_out, staged
from feedgate.llm.files import ship
from feedgate.llm.mph import mix
from feedgate.llm.words import DIGIT, LOWER, OTHER, UPPER, Flat

#: Weights: 2 to the power of this, and one for all texts.
BITS = 18
#: Most labelled rows a model is fitted on, and most bytes of their texts; dealt to as many
#: learners, each holding its share (about ten bytes for one of text) and reading it so often.
TRAIN_ROWS = 24_000
TRAIN_BYTES = 1 << 28
LEARNERS = 8
EPOCHS = 3
#: Step size and its start, and the two regularisers.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-3
#: A text's features weigh this together, however many they are.
SCALE = 10.0
THRESHOLD = 0.7

_GRAMS = [np.uint64(x) for x in (0x51, 0x52, 0x53, 0x54, 0x55)]


def _columns(flat: Flat) -> dict[str, np.ndarray]:
    """Hash and shape of each word: case, digits, signs, length."""
    unit = np.zeros(256, np.uint64)
    for kind in range(256):
        for i, bit in enumerate((UPPER, LOWER, DIGIT, OTHER)):
            if kind & bit:
                unit[kind] = 1 << 16 * i
    counts = flat.sums(unit[flat.kind])
    upper, lower, digit, other = ((counts >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(4))
    case = np.where(upper == 0, 0, np.where(lower == 0, 3, np.where(upper == 1, 1, 2)))
    length = np.minimum(np.log2(flat.end - flat.start + 1).astype(np.int64), 7)
    shape = case + 4 * (digit > 0) + 8 * np.minimum(other, 3).astype(np.int64) + 32 * length
    return {"hash": flat.hashes(), "shape": shape}


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``first, index``: rows ``first[i]`` to ``first[i + 1]`` of ``index`` are text i's features.

    Each word has five: itself, it with the word before, and its shape alone and with those of one
    and two words before.  A shape also says whether the word repeats the one before.
    """
    found = text_words.words(texts, 255, _columns)
    n = len(found.start)
    index = np.zeros((n, 5), np.uint32)
    if n:
        word, shape = found.columns["hash"], found.columns["shape"].astype(np.uint64)
        opens = np.zeros(n, bool)
        opens[found.first[:-1][np.diff(found.first) > 0]] = True

        def before(x):
            y = np.concatenate([x[:1], x[:-1]])
            y[opens] = 0
            return y

        shape = shape * np.uint64(2) + (word == before(word)) + np.uint64(1)
        pair = before(shape) * np.uint64(1024) + shape
        triple = before(before(shape)) * np.uint64(1 << 20) + pair
        grams = [word, word + mix(before(word)), shape, pair, triple]
        for i, gram in enumerate(grams):
            index[:, i] = mix(mix(gram + _GRAMS[i]) ^ _GRAMS[i]) >> np.uint64(64 - BITS)
    return found.first, index


def _vector(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's sparse vector; the last weight belongs to every text."""
    at, counts = np.unique(index, return_counts=True)
    return np.append(at, 1 << BITS).astype(np.int64), np.append(counts * (SCALE / max(1, len(index))), 1.0)


def follow_the_leader(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """FTRL-Proximal over sparse examples, one at a time."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, label in examples:
            w = weights(z[at], n[at])
            g = (_logistic(w @ x) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(z, n)


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> DataFrame:
    """``doc_id, text, quality, _order``: the labelled texts that train.

    Those with the smallest hashes of their id, so reruns agree: ``rows`` at most, and as many as
    have ``size`` bytes of text together.  Equal rows of a document train once; null labels, ids and
    texts are left out.
    """
    order = ["_order", "doc_id", "quality", "_text"]
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .select("doc_id", "quality", F.xxhash64("doc_id").alias("_order"))
    )
    first = known.orderBy(*order[:3]).limit(rows)
    texts = docs.select("doc_id", "text").filter("text is not null").withColumn("_text", F.xxhash64("text"))
    # Broadcast: at most ``rows`` rows of a few numbers, here and below.
    sized = texts.join(F.broadcast(first), "doc_id").select(*order, F.octet_length("text").cast("long").alias("_bytes"))
    sized = staged(sized.distinct().orderBy(*order).limit(rows), "quality-sample")
    upto = F.sum("_bytes").over(Window.orderBy(*order))  # of ``rows`` rows
    chosen = sized.withColumn("_upto", upto).filter(F.col("_upto") <= size).drop("_upto", "_bytes")
    found = texts.join(F.broadcast(chosen), ["doc_id", "_text"]).dropDuplicates(["doc_id", "_text", "quality"])
    return found.select("doc_id", "text", "quality", "_order")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> np.ndarray | None:
    """Weights learnt from ``labels.quality`` of the rows of ``sample``; None without any.

    Every learner sees its share in hash order and the learners' weights are averaged: what reaches
    the driver is one array of fixed size from each.
    """
    ship(docs.sparkSession)
    chosen = sample(docs, labels, rows, size)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches):
            at, x = [], []
            for _, texts in text_words.grouped(batch.column("text").to_pylist()):
                first, index = features(texts)
                for a, b in zip(first[:-1], first[1:]):
                    places, values = _vector(index[a:b])
                    at.append(places.astype("<i8").tobytes())
                    x.append(values.astype("<f8").tobytes())
            columns = [batch.column("_order"), batch.column("quality").cast(pa.int32()), pa.array(at, pa.binary()), pa.array(x, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_order", "quality", "at", "x"])

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_order", "ascending"), ("at", "ascending"), ("quality", "ascending")])
        examples = [
            (np.frombuffer(a, "<i8"), np.frombuffer(x, "<f8"), y)
            for a, x, y in zip(*(group.column(c).to_pylist() for c in ("at", "x", "quality")))
        ]
        return pa.table({"weights": pa.array([follow_the_leader(examples).astype("<f4").tobytes()], pa.binary())})

    learnt = (
        chosen.mapInArrow(vectors, "_order bigint, quality int, at binary, x binary")
        .groupBy(F.pmod("_order", F.lit(LEARNERS)))
        .applyInArrow(learn, "weights binary")
        .collect()
    )
    if not learnt:
        return None
    # Added in one order, whatever order the learners end in.
    arrays = sorted(bytes(r["weights"]) for r in learnt)
    return np.mean([np.frombuffer(a, "<f4").astype(np.float64) for a in arrays], axis=0).astype(np.float32)


def scores(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Probability of label 1: a dot product of each text's vector with the weights."""
    first, index = features(texts)
    size = np.diff(first)
    total = np.zeros(len(texts))
    if len(index):
        each = weights[index].astype(np.float64).sum(axis=1)
        total[size > 0] = np.add.reduceat(each, first[:-1][size > 0]) * (SCALE / size[size > 0])
    return _logistic(total + float(weights[-1]))


def score_quality(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``score``, the probability of good quality.

    Only the whole text counts.  Null and empty texts have no features: their score is that of
    the common weight alone.  Without a model (no labels) every score is 1, since nothing speaks
    against a text.  A column named score is replaced; rows may repeat; no rows give no rows.
    """
    ship(docs.sparkSession)
    own = [f for f in docs.schema if f.name != "score"]
    rest = docs.select(*[F.col(f"`{f.name}`") for f in own])
    if weights is None:
        return rest.withColumn("score", F.lit(1.0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches):
            found = [scores(texts, weights) for _, texts in text_words.grouped(batch.column("text").to_pylist())]
            columns = [*batch.columns, pa.array(np.concatenate(found) if found else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score"])

    return rest.mapInArrow(rows, T.StructType([*own, T.StructField("score", T.DoubleType())]))


def predicted(score: Column) -> Column:
    return F.when(score >= THRESHOLD, 1).otherwise(0)
