"""Language of texts and of their spans: script ranges, word scores, Viterbi with a switching cost."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from feedgate.llm import words as text_words
from feedgate.llm.common import held_out, staged
from feedgate.llm.files import ship
from feedgate.llm.mph import mix
from feedgate.llm.words import LETTER, Flat

#: Documents of each language a model is fitted on, at most.
TRAIN_DOCS = 2_000
#: Ids are hashed below this for sampling.
HASHES = 1 << 40
#: Rows of a sample up to which it is broadcast.
BROADCAST_ROWS = 1_000_000
#: Letter trigrams are hashed to 2 to the power of this.
BITS = 16
#: Log probabilities are whole numbers of this part of a nat, so sums do not depend on batches.
NAT = 1024
#: Cost of a change of language between words; a word says at most ``WORD`` against one.
SWITCH = 12 * NAT
WORD = 16 * NAT
#: A language uses a script that has this share of its letters.
USES = 0.01
UNKNOWN = "und"

#: First and last code points of scripts' main blocks in Unicode.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF)],
}


@cache
def _scripts() -> np.ndarray:
    """Script of each code point, from 1; 0 for all others."""
    out = np.zeros(0x32401, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            out[first : last + 1] = number
    return out


def _trigrams(flat: Flat) -> np.ndarray:
    """Hash of each letter with its neighbours; whatever is no letter counts as a blank."""
    code = np.where(flat.kind & LETTER, flat.code, 32).astype(np.uint64)
    blank = np.full(1, 32, np.uint64)
    before, after = np.concatenate([blank, code[:-1]]), np.concatenate([code[1:], blank])
    return (mix((before << np.uint64(42)) ^ (code << np.uint64(21)) ^ after) >> np.uint64(64 - BITS)).astype(np.int64)


def _letters(flat: Flat) -> np.ndarray:
    return (flat.kind & LETTER) != 0


class Model:
    """``languages`` in order, log probabilities of trigrams in each, and the scripts each uses."""

    def __init__(self, counted: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counted)
        grams = np.array([counted[x][0] for x in self.languages], np.float64) + 0.1
        self.logs = np.round(np.log(grams / grams.sum(axis=1, keepdims=True)) * NAT).astype(np.int32)
        scripts = np.array([counted[x][1] for x in self.languages], np.float64)
        self.uses = scripts >= USES * np.maximum(scripts.sum(axis=1, keepdims=True), 1)

    def word_scores(self, flat: Flat) -> dict[str, np.ndarray]:
        """How much less likely each word is in each language than in the best candidate.

        Candidates are the languages that use the script of the word's first letter, if any do.
        """
        grams, letters = _trigrams(flat), _letters(flat)
        scores = np.empty((len(flat.start), len(self.languages)), np.int64)
        for i, logs in enumerate(self.logs):
            scores[:, i] = flat.sums(np.where(letters, logs[grams], 0).astype(np.int64))
        candidate = self.uses[:, _scripts()[flat.code[flat.start]]].T
        candidate |= ~candidate.any(axis=1, keepdims=True)
        scores[~candidate] = -(1 << 60)
        if len(scores):
            scores -= scores.max(axis=1, keepdims=True)
        return {"score": np.maximum(scores, -WORD)}


def _train_counts(docs: DataFrame, docs_of_each: int) -> DataFrame:
    """``lang, at, n``: counts of trigrams (their hash) and of scripts (-1 less their number)."""
    ship(docs.sparkSession)
    order = Window.partitionBy("lang").orderBy("_order", "doc_id")
    known = docs.filter("lang is not null and text is not null and doc_id is not null")
    narrow = known.filter(~held_out(F.col("doc_id"))).select(
        "doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)).alias("_order")
    )
    # Few more than wanted have a hash this small, so a hot language's rank meets only those.
    # The counts are written, one row per language: Spark sees their size and moves no other rows.
    counts = staged(narrow.groupBy("lang").count(), "language-sizes")
    share = F.lit(1.5 * docs_of_each + 100) / F.col("count")
    sample = (
        narrow.join(counts, "lang")
        .filter(F.col("_order") < share * HASHES)
        .withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") <= docs_of_each)
        .select("doc_id", "lang")
        .distinct()
    )
    sample = staged(sample, "language-sample")
    if sample.count() <= BROADCAST_ROWS:  # an id and a name each
        sample = F.broadcast(sample)
    chosen = known.select("doc_id", "lang", "text").join(sample, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in text_words.slices(batches):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                grams, scripts = counts.setdefault(lang, (np.zeros(1 << BITS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)))

                def add(flat, grams=grams, scripts=scripts):
                    letters = _letters(flat)
                    grams += np.bincount(_trigrams(flat)[letters], minlength=len(grams))
                    scripts += np.bincount(_scripts()[flat.code[letters]], minlength=len(scripts))
                    return {}

                for _, some in text_words.grouped([t for k, t in zip(langs, texts) if k == lang]):
                    text_words.words(some, LETTER, add)
        for lang, (grams, scripts) in counts.items():
            for values, places in ((grams, np.arange(len(grams))), (scripts, -1 - np.arange(len(scripts)))):
                seen = np.nonzero(values)[0]
                if not len(seen):
                    continue  # a language without letters
                columns = [pa.array([lang] * len(seen), pa.string()), pa.array(places[seen].astype(np.int32)), pa.array(values[seen])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "at", "n"])

    return chosen.mapInArrow(count, "lang string, at int, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, docs_of_each: int = TRAIN_DOCS) -> Model | None:
    """A model from ``text`` and ``lang`` of documents outside the held-out fold; None without any.

    A language whose texts have no letters is not learned.

    At most ``docs_of_each`` documents of each language count, those with the smallest hashes of
    their id.  Tasks count, Spark adds the counts, a task packs a language's (at most 65,536
    and a few), and one array per language (half a megabyte) reaches the driver.
    """

    def pack(group: pa.Table) -> pa.Table:
        at, n = group.column("at").to_numpy(), group.column("n").to_numpy()
        grams, scripts = np.zeros(1 << BITS, "<i8"), np.zeros(len(SCRIPTS) + 1, "<i8")
        grams[at[at >= 0]] = n[at >= 0]
        scripts[-1 - at[at < 0]] = n[at < 0]
        rows = {"grams": pa.array([grams.tobytes()], pa.binary()), "scripts": pa.array([scripts.tobytes()], pa.binary())}
        return pa.table({"lang": group.column("lang").slice(0, 1), **rows})

    schema = "lang string, grams binary, scripts binary"
    counted = _train_counts(docs, docs_of_each).groupBy("lang").applyInArrow(pack, schema).collect()
    found = {r["lang"]: tuple(np.frombuffer(bytes(r[c]), "<i8") for c in ("grams", "scripts")) for r in counted}
    return Model(found) if found else None


def viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best language of each word, all texts side by side; ties go to the first language.

    A change costs the same between any two languages, so a word's best way comes from the same
    language or from the best one.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    starts, left = first[:-1][order], size[order]
    steps = int(left[0]) if len(left) else 0
    active = np.searchsorted(-left, -np.arange(steps), side="left")  # texts with more words than t
    best = np.zeros(len(scores), np.int32)
    stays = np.zeros(scores.shape, bool)
    value = np.zeros((len(order), scores.shape[1]), np.int64)
    for t in range(steps):
        rows, now = starts[: active[t]] + t, value[: active[t]]
        top = now.argmax(axis=1)
        change = now[np.arange(len(now)), top] - SWITCH
        stay = now >= change[:, None]
        best[rows], stays[rows] = top, stay
        now[:] = np.where(stay, now, change[:, None]) + scores[rows]
    path = np.zeros(len(scores), np.int32)
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        rows, now = starts[: active[t]] + t, state[: active[t]]
        path[rows] = now
        now[:] = np.where(stays[rows, now], now, best[rows])
    return path


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred``, ``score`` and ``spans``.

    ``spans`` are ``(start, end, lang)`` in characters, from the first to the last letter of each
    run of words in one language.  ``lang_pred`` is the language with most letters, the first by
    name on a tie, and ``score`` its share of all letters.  Null texts, texts without a letter, and
    all texts where there is no model are ``und`` with score 0 and no spans.  Columns with these
    names are replaced; rows may repeat; no rows give no rows.
    """
    ship(docs.sparkSession)
    names = ("lang_pred", "score", "spans")
    own = [f for f in docs.schema if f.name not in names]
    spans = T.StructType().add("start", "integer").add("end", "integer").add("lang", "string")
    schema = T.StructType([*own]).add("lang_pred", "string").add("score", "double").add("spans", T.ArrayType(spans))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches, 4096):
            texts = batch.column("text").to_pylist()
            order = sorted(range(len(texts)), key=lambda i: -len(texts[i] or ""))  # long texts together
            found = [(UNKNOWN, 0.0, [])] * len(texts)
            if model is not None:
                for at, some in text_words.grouped([texts[i] for i in order]):
                    for k, row in enumerate(_identified(some, model)):
                        found[order[at + k]] = row
            langs, shares, spans = zip(*found) if found else ((), (), ())
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return docs.select(*[F.col(f"`{f.name}`") for f in own]).mapInArrow(rows, schema)


def _identified(texts: list[str], model: Model) -> Iterator[tuple]:
    found = text_words.words(texts, LETTER, model.word_scores)
    if not len(found.start):
        yield from [(UNKNOWN, 0.0, [])] * len(texts)
        return
    path = viterbi(found.columns["score"], found.first)
    turns = np.concatenate([[0], np.nonzero(np.diff(path))[0] + 1])
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if a == b:
            yield UNKNOWN, 0.0, []
            continue
        letters = np.bincount(path[a:b], (found.end - found.start)[a:b], len(model.languages))
        top = int(letters.argmax())
        inner = turns[np.searchsorted(turns, a, side="right") : np.searchsorted(turns, b, side="left")].tolist()
        spans = [
            {"start": int(found.start[i]), "end": int(found.end[j - 1]), "lang": model.languages[path[i]]}
            for i, j in zip([a, *inner], [*inner, b])
        ]
        yield model.languages[top], float(letters[top] / letters.sum()), spans
