"""Periodic runs of words: match lengths along sparse diagonals, swept word by word."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from feedgate.llm import words as text_words
from feedgate.llm.files import ship

#: Words of the shortest run; a run also has two periods at least.
LEAST = 12
#: Words that every diagonal of a run matches in a row: max(LEAST - lag, lag) for any lag.
GRAM = LEAST // 2
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")


def _named(keys: np.ndarray) -> np.ndarray:
    """Small numbers for the keys that stand at two places or more; -1 for the others and for -1."""
    out = np.full(len(keys), -1, np.int64)
    known = np.nonzero(keys >= 0)[0]
    _, name, times = np.unique(keys[known], return_inverse=True, return_counts=True)
    out[known] = np.where(times[name] > 1, name, -1)
    return out


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Names of the stretches made of one named in ``left`` and, ``shift`` further, one in ``right``."""
    follows = np.full(len(left), -1, np.int64)
    if shift < len(left):
        follows[: len(left) - shift] = right[shift:]
    known = (left >= 0) & (follows >= 0)
    return _named(np.where(known, left * (right.max(initial=0) + 1) + follows, -1))


def _opened(ids: np.ndarray, grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``word, lag`` where a diagonal with ``low <= lag < high`` begins to match for a whole gram.

    A word's earlier occurrences are those of the gram it starts.  A diagonal begins where the
    words before differ, so occurrences after the same word are passed over together.
    """
    at = np.nonzero(grams >= 0)[0]
    at = at[np.argsort(grams[at], kind="stable")]
    gram, n = grams[at], np.arange(len(at))
    before = np.where(at > 0, ids[at - 1], -1)
    changes = np.concatenate([[True], (gram[1:] != gram[:-1]) | (before[1:] != before[:-1])])
    head = np.maximum.accumulate(np.where(changes, n, 0))  # first of the neighbours after the same word
    span = len(ids) + high
    nearest = np.searchsorted(gram * span + at, gram * span + at - high, side="right")
    words, lags = [], []
    row, other = n, n - 1
    while True:
        row, other = (x[other >= nearest[row]] for x in (row, other))
        if not len(row):
            break
        differs = before[other] != before[row]
        some, last = row[differs], other[differs]
        first = np.maximum(head[last], nearest[some])
        size = last - first + 1
        pair = np.repeat(some, size)
        past = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        lag = at[pair] - at[past]
        words.append(at[pair][lag >= low])
        lags.append(lag[lag >= low])
        other = head[other] - 1
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *words]), np.concatenate([empty, *lags])


def _diagonals(ids: np.ndarray, texts: np.ndarray) -> tuple[list[int], list[int]]:
    """``word, lag`` in order where diagonals open that may become runs.

    A run of lag q matches q words in a row, and ``GRAM`` at least.  Lags from L to 2L - 1 open
    where L words match, for L = 6, 12, 24 and so on while such stretches repeat in a text: that
    leaves, in any text, diagonals in proportion to its words.
    """
    one = _named(texts * (ids.max(initial=0) + 1) + ids)
    two = _joined(one, one, 1)
    grams, size = _joined(_joined(two, two, 2), two, 4), GRAM
    found = []
    while (grams >= 0).any():
        found.append(_opened(ids, grams, 1 if size == GRAM else size, 2 * size))
        grams, size = _joined(grams, grams, size), 2 * size
    if not found:
        return [], []
    word, lag = map(np.concatenate, zip(*found))
    order = np.lexsort((lag, word))
    return word[order].tolist(), lag[order].tolist()


def runs(ids: np.ndarray, texts: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``start, end, period`` of all runs in a sequence of words, in the order they end.

    ``ids`` number the words; ``texts`` (ascending) say whose they are, and every text ends with a
    number of its own that nothing matches.  One sweep over the words: a word that equals the one a
    lag before makes the match of that active lag one longer; a lag it does not continue ends, and
    is a run at once if it is long enough.  While a lag is active, its multiples from the same
    start are not opened: they would end with it.
    """
    opens, lags = _diagonals(ids, texts)
    word = ids.tolist()
    active: dict[int, int] = {}  # lag: first word of its stretch
    out, k, i = [], 0, 0
    while k < len(opens) or active:
        if not active:
            i = opens[k]
        now = word[i]
        for q in [q for q in active if word[i - q] != now]:
            start = active.pop(q)
            if i - start >= max(least, 2 * q):
                out.append((start, i, q))
        while k < len(opens) and opens[k] == i:
            q = lags[k]
            if not any(start == i - q and q % r == 0 for r, start in active.items()):
                active[q] = i - q
            k += 1
        i += 1
    return out


def _found(texts: list[str], least: int) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each text."""
    numbers = defaultdict(count().__next__)
    words = [text.encode("utf-8", "surrogatepass").split() for text in texts]  # ASCII white space
    sizes = np.array([len(w) + 1 for w in words])
    first = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(first[-1], np.int64)
    for i, w in enumerate(words):
        ids[first[i] : first[i + 1] - 1] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
    ids[first[1:] - 1] = len(numbers) + np.arange(len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    per_text: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for start, end, period in runs(ids, owner, least):
        i = int(owner[start])
        per_text[i].append((start - int(first[i]), end - int(first[i]), period))
    for i, w in enumerate(words):
        own = sorted((s, p, e) for s, e, p in per_text.get(i, ()))
        if own:
            edges = np.zeros(len(w) + 1, np.int64)
            for s, p, e in own:
                edges[s + p] += 1
                edges[e] -= 1
            w = [w[x] for x in np.nonzero(np.cumsum(edges[:-1]) == 0)[0].tolist()]
        yield [{"start": s, "length": e - s, "period": p} for s, p, e in own], b" ".join(w).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All rows and columns of ``docs`` with ``runs`` and ``collapsed``.

    Words are what stands between ASCII white space.  A run is a stretch of words with smallest
    period q (words q apart are equal), of ``least`` and 2q words or more, which no neighbouring
    word extends.  ``runs`` are ``(start, length, period)``, start in words from 0, by start and
    period.  ``collapsed`` are the words joined by one blank, without those that stand in a run
    behind its first q words.

    Null, empty and wordless texts have no runs and collapse to an empty text.  Texts are worked on
    whole, whatever their length, some at a time.  Rows may repeat, ids are not looked at; columns
    named runs or collapsed are replaced; no rows give no rows.
    """
    if least < LEAST:
        raise ValueError(f"diagonals are opened for runs of {LEAST} words or more")
    ship(docs.sparkSession)
    own = [f for f in docs.schema if f.name not in ("runs", "collapsed")]
    schema = T.StructType([*own]).add("runs", T.ArrayType(RUN)).add("collapsed", "string")
    run = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_words.slices(batches):
            at = 0
            # Slices again: what goes out at once is as long as what was worked on at once.
            for _, texts in text_words.grouped(batch.column("text").to_pylist()):
                lists, collapsed = zip(*_found(texts, least))
                columns = [*batch.slice(at, len(texts)).columns, pa.array(lists, run), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "runs", "collapsed"])
                at += len(texts)

    return docs.select(*[F.col(f"`{f.name}`") for f in own]).mapInArrow(rows, schema)
