"""Benchmark decontamination: BM25 index of test items, block-max WAND per passage, overlap check."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from feedgate.llm import words as text_words
from feedgate.llm.common import in_order, staged, with_rank, with_running
from feedgate.llm.files import ship
from feedgate.llm.mph import mix
from feedgate.llm.words import DIGIT, LETTER, Flat
from feedgate.session import work_dir

#: BM25's saturation and length weight.
K1, B = 1.2, 0.75
#: Retrieved are items from which a passage has this share of the most any passage can have.
RETRIEVE = 0.5
#: Words of a shingle, and the share of shingles of question and of answer that must be there.
SHINGLE = 5
OVERLAP = 0.5
#: Share of an item's words that are its question, where the table has no columns for it.
QUESTION = 2 / 3
#: Items of a block, and items and about how many terms of one index; more take several indexes.
BLOCK_ITEMS = 32
INDEX_ITEMS = 4096
INDEX_TERMS = 1 << 18


def _hashes(flat: Flat) -> dict[str, np.ndarray]:
    return {"hash": flat.hashes()}


def term_lists(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``first, hash``: lower-cased runs of letters and digits of each text, as hashes.

    Letters of scripts without blanks between words, as Han and kana, are terms of their own.
    """
    found = text_words.words(texts, LETTER | DIGIT, _hashes, letters=True)
    return found.first, found.columns.get("hash", np.zeros(0, np.uint64))


def shingles(terms: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` terms."""
    return np.unique(runs(terms, size))


def runs(terms: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` terms that starts at each place."""
    out = np.zeros(max(0, len(terms) - size + 1), np.uint64)
    for i in range(size if len(out) else 0):
        out = mix(out + terms[i : len(terms) - size + 1 + i])
    return out


def part(terms: np.ndarray) -> tuple[int, np.ndarray]:
    """Shingle length and shingles of a question or answer; a short one is one shingle."""
    size = min(SHINGLE, len(terms))
    return size, shingles(terms, size)


@dataclass
class Block:
    """Items of like length.

    ``place[r]`` is the place of the block's term r among the index's terms; ``impact[r, i]`` what it
    adds to item i.  ``pivots`` are the items, from ``first_pivot[r]`` on, that need term r
    or another of their pivots: all their other terms together stay below what they need.
    """

    items: np.ndarray
    place: np.ndarray
    impact: np.ndarray
    first_pivot: np.ndarray
    pivots: np.ndarray
    needs: np.ndarray
    words: int


@dataclass
class Index:
    """Terms as sorted hashes, blocks of items, and each item's question and answer.

    ``short[n]`` are the items of n terms, fewer than a shingle: sorted hashes of their runs, the
    items and their scores.
    """

    terms: np.ndarray
    blocks: list[Block]
    parts: dict[int, tuple[tuple[int, np.ndarray], ...]]
    ids: list
    short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def item_rows(items: DataFrame) -> DataFrame:
    """``item_id, terms`` of each item with a term; terms as hashes in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            first, terms = term_lists(texts)
            lists = [terms[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(lists, pa.binary())], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(rows, f"item_id {kind}, terms binary")
    return found.filter(F.length("terms") > 0).distinct()


def build_indexes(
    items: DataFrame, index_items: int = INDEX_ITEMS, index_terms: int = INDEX_TERMS
) -> Iterator[Index]:
    """Indexes of at most ``index_items`` items each, in order of length; short items apart.

    The terms of an index's items, but for the last one, are at most ``index_terms``.

    Document frequencies are counted over all items; an index is collected when it is used, so the
    driver and the tasks hold one at a time, whatever the number of items.
    """
    rows = item_rows(items).withColumn("size", F.expr("length(terms) div 8"))
    placed = in_order(rows, [F.col("size"), F.col("item_id"), F.col("terms")], "benchmark-order")
    ranked = with_rank(placed.withColumn("_place", F.col("_at")), "n").withColumnRenamed("_place", "_at")
    rows = staged(with_running(ranked, "size", "upto"), "benchmark-items")
    total = rows.agg(
        F.count(F.lit(1)).alias("items"), F.avg("size").alias("length"), F.count_if(F.col("size") < SHINGLE).alias("short")
    ).first()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.unique(np.frombuffer(t, "<u8")) for t in batch.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(each).view(np.int64))], ["term"])

    counts = rows.select("terms").mapInArrow(frequencies, "term bigint").groupBy("term").count()
    counts = staged(counts, "benchmark-terms")
    long = F.col("n") >= total["short"]
    nth = F.floor((F.col("n") - F.when(long, total["short"]).otherwise(0)) / index_items)
    terms_before = F.floor((F.col("upto") - F.col("size")) / index_terms)
    # One number per index: each starts where a bound is passed.
    found = rows.groupBy(long, nth, terms_before).agg(F.min("n").alias("start")).select("start").collect()
    starts = sorted(r["start"] for r in found)
    for start, stop in zip(starts, [*starts[1:], total["items"]]):
        some = rows.filter((F.col("n") >= start) & (F.col("n") < stop))
        own = some.select("terms").mapInArrow(frequencies, "term bigint").distinct()
        known = dict(map(tuple, counts.join(own, "term", "left_semi").collect()))
        some = some.orderBy("n").select("item_id", "terms").collect()
        yield _index([(r["item_id"], np.frombuffer(bytes(r["terms"]), "<u8")) for r in some], known, total["items"], total["length"])


def _index(items: list, counts: dict[int, int], n_items: int, mean: float) -> Index:
    all_terms = np.sort(np.array(list(counts), np.int64).view(np.uint64))
    df = np.array([counts[int(t)] for t in all_terms.view(np.int64)], np.float64)
    idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
    blocks, parts, short = [], {}, {}

    def impacts(at, tf, size):
        return idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))

    for i, (_, own) in enumerate(items):
        if len(own) < SHINGLE:
            at, tf = np.unique(own, return_counts=True)
            score = impacts(np.searchsorted(all_terms, at), tf, len(own)).sum()
            short.setdefault(len(own), []).append((runs(own, len(own))[0], i, score))
    short = {n: tuple(map(np.array, zip(*sorted(found)))) for n, found in short.items()}
    for start in range(sum(len(own) < SHINGLE for _, own in items), len(items), BLOCK_ITEMS):
        some = items[start : start + BLOCK_ITEMS]
        terms = np.unique(np.concatenate([t for _, t in some]))
        place = np.searchsorted(all_terms, terms)
        impact, pivot = np.zeros((len(terms), len(some))), np.zeros((len(terms), len(some)), bool)
        for i, (_, own) in enumerate(some):
            at, tf = np.unique(own, return_counts=True)
            rows = np.searchsorted(terms, at)
            impact[rows, i] = impacts(place[rows], tf, len(own))
            # The smallest impacts, as many as stay below the need together, are no pivots.
            rows = rows[np.argsort(impact[rows, i])]
            below = np.cumsum(impact[rows, i]) < impact[:, i].sum() * RETRIEVE * (1 - 1e-9)
            pivot[rows[~below], i] = True
            cut = round(len(own) * QUESTION)
            parts[start + i] = (part(own[:cut]), part(own[cut:]))
        first = np.concatenate([[0], np.cumsum(pivot.sum(axis=1))])
        blocks.append(
            Block(
                np.arange(start, start + len(some)), place, impact, first, np.nonzero(pivot)[1],
                impact.sum(axis=0) * RETRIEVE * (1 - 1e-9), max(len(t) for _, t in some),
            )
        )
    return Index(all_terms, blocks, parts, [i for i, _ in items], short)


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``which, at``: for each range its number and its places one after the other."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]


def retrieve(index: Index, first: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """``text, from, to, item, score``: passages and the items they reach, by block-max WAND.

    A block's passages are twice as long as its longest item and start every such length, so each
    occurrence of an item lies whole in one.  All passages of a batch go on together: those that
    hold a pivot of an item are its candidates; candidates stay while the block maxima of the
    passage's terms add up to what the item needs; what is left is scored, each term once.
    """
    if not index.blocks:
        return
    place = np.searchsorted(index.terms, terms)
    place[place == len(index.terms)] = 0
    at = np.nonzero(index.terms[place] == terms)[0]
    place = place[at]
    order = np.argsort(place, kind="stable")
    before = np.full(len(at), -1)  # where the same term stood last
    again = place[order[1:]] == place[order[:-1]]
    before[order[1:][again]] = at[order[:-1][again]]
    text = np.searchsorted(first, at, side="right") - 1
    size = np.diff(first)
    row_of = np.full(len(index.terms), -1)  # of the block at hand; one array for all of them
    for block in index.blocks:
        row_of[block.place] = np.arange(len(block.place))
        row = row_of[place]
        row_of[block.place] = -1
        inside = row >= 0
        hit, row, last, owner = at[inside], row[inside], before[inside], text[inside]
        step = block.words
        passages = np.maximum(1, -(-size // step) - 1) * (size > 0)
        base = np.cumsum(passages) - passages
        # A pivot stands in the passage that starts in its stretch, and in the one before.
        which, pivot = _spread(block.first_pivot[row], np.diff(block.first_pivot)[row])
        nth, whose = ((hit - first[owner]) // step)[which], owner[which]
        item = block.pivots[pivot]
        here, earlier = nth < passages[whose], nth > 0
        window = np.concatenate([(base[whose] + nth)[here], (base[whose] + nth - 1)[earlier]])
        pairs = np.unique(window * BLOCK_ITEMS + np.concatenate([item[here], item[earlier]]))
        window, item = pairs // BLOCK_ITEMS, pairs % BLOCK_ITEMS
        whose = np.searchsorted(base, window, side="right") - 1
        start = first[whose] + (window - base[whose]) * step
        end = np.minimum(start + 2 * step, first[whose + 1])
        low, high = np.searchsorted(hit, start), np.searchsorted(hit, end)
        upto = np.concatenate([[0.0], np.cumsum(block.impact.max(axis=1)[row])])
        able = upto[high] - upto[low] >= block.needs[item] - 1e-6
        item, whose, start, end, low, high = (x[able] for x in (item, whose, start, end, low, high))
        pair, place_of = _spread(low, high - low)
        once = last[place_of] < start[pair]
        adds = np.where(once, block.impact[row[place_of], item[pair]], 0.0)
        score = np.bincount(pair, adds, minlength=len(item))
        for k in np.nonzero(score >= block.needs[item])[0].tolist():
            yield int(whose[k]), int(start[k]), int(end[k]), int(block.items[item[k]]), float(score[k])


def short_matches(index: Index, first: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """``text, item, score``: items shorter than a shingle whose whole run stands in a text."""
    for size, (hashes, items, scores) in index.short.items():
        found = runs(terms, size)
        low, high = np.searchsorted(hashes, found), np.searchsorted(hashes, found, side="right")
        at = np.nonzero(high > low)[0]
        text = np.searchsorted(first, at, side="right") - 1
        inside = at + size <= first[text + 1]
        at, text = at[inside], text[inside]
        which, place = _spread(low[at], high[at] - low[at])
        for pair in np.unique(text[which] * len(items) + place).tolist():
            yield pair // len(items), int(items[pair % len(items)]), float(scores[pair % len(items)])


def matches(index: Index, texts: list[str]) -> list[dict[int, tuple]]:
    """For each text its items with ``(score, question, answer)``: retrieved and verified."""
    first, terms = term_lists(texts)
    out: list[dict[int, tuple]] = [{} for _ in texts]
    for text, item, score in short_matches(index, first, terms):
        out[text][item] = (score, 1.0, 1.0)
    for text, a, b, item, score in retrieve(index, first, terms):
        shares = [np.isin(own, shingles(terms[a:b], size)).mean() for size, own in index.parts[item]]
        if min(shares) >= OVERLAP:
            best = out[text].get(item)
            if best is None or (score, *shares) > best:
                out[text][item] = (score, *shares)
    return out


def find_items(
    docs: DataFrame, items: DataFrame, index_items: int = INDEX_ITEMS, index_terms: int = INDEX_TERMS
) -> DataFrame:
    """All rows and columns of ``docs`` with ``items``: ``(item_id, score, question, answer)`` found.

    Each item is matched by its words (runs of letters and digits, lower-cased; single letters in
    scripts without blanks between words).  The first two thirds of an item are its question and
    the rest its answer; of both, ``OVERLAP`` of the five-word shingles must stand in one passage.
    An item of fewer than five words is not cut in two: its words must stand in the text in a row.  With one index nothing is shuffled.  More are
    used one after the other, so that tasks hold one at a time: the documents are written once with
    row numbers, what each index finds is written as rows, and these are joined to the documents.

    Null and empty texts have no items.  Items without a word match nothing; repeated items are
    found under each of their ids; null item ids stay null.  A column named items is replaced; rows
    may repeat; without items, or documents, the lists or the result are empty.
    """
    ship(docs.sparkSession)
    own = [f for f in docs.schema if f.name != "items"]
    kind = items.schema["item_id"].dataType
    found = T.ArrayType(T.StructType().add("item_id", kind).add("score", "double").add("question", "double").add("answer", "double"))
    schema = T.StructType([*own, T.StructField("items", found)])
    context = docs.sparkSession.sparkContext
    out = docs.select(*[F.col(f"`{f.name}`") for f in own])
    none = F.array().cast(found)
    indexes = build_indexes(items, index_items, index_terms)
    index, further = next(indexes, None), next(indexes, None)
    if further is None:
        out = out.withColumn("items", none)
        return out if index is None else out.mapInArrow(_finder(context.broadcast(index)), schema)
    key = "_row"
    while key in out.columns:
        key += "_"
    out = staged(out.withColumn(key, F.monotonically_increasing_id()), "benchmark-documents")
    texts = out.select(F.col(f"`{key}`").alias("row"), "text").withColumn("items", none)
    # Texts stay behind: a hit is a row number, the index's number and the items.
    hits, path = T.StructType().add("row", "long").add("nth", "integer").add("items", found), work_dir(docs.sparkSession, "benchmark-hits")
    for nth, index in enumerate(chain([index, further], indexes)):
        shared = context.broadcast(index)
        some = texts.mapInArrow(_finder(shared), texts.schema).filter(F.size("items") > 0)
        some.select("row", F.lit(nth).alias("nth"), "items").write.mode("append").parquet(path)
        shared.destroy()
    every = F.array_sort(F.collect_list(F.struct("nth", "items")))
    lists = docs.sparkSession.read.schema(hits).parquet(path).groupBy(F.col("row").alias(key)).agg(
        F.flatten(every["items"]).alias("items")
    )
    joined = out.join(lists, key, "left")
    return joined.select(*[F.col(f"`{f.name}`") for f in own], F.coalesce("items", none).alias("items"))


def _finder(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in text_words.slices(batches):
            lists = batch.column("items").to_pylist()
            for at, texts in text_words.grouped(batch.column("text").to_pylist()):
                for k, hits in enumerate(matches(index, texts)):
                    lists[at + k] += [
                        {"item_id": index.ids[i], "score": s, "question": float(q), "answer": float(a)}
                        for i, (s, q, a) in sorted(hits.items())
                    ]
            column = pa.array(lists, batch.schema.field("items").type)
            yield batch.set_column(batch.schema.get_field_index("items"), "items", column)

    return rows
