"""Words of many texts at once as arrays: places, hashes and what else is summed over letters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from feedgate.llm.mph import mix

#: Kinds of characters, as bits.
UPPER, LOWER, DIGIT, OTHER = 1, 2, 4, 8
LETTER = 16
#: Characters of one array; arrays of a batch take about 50 bytes for each.
FLAT = 1 << 20
#: Code points from here on are no letters or digits.
_LAST = 0x32400
_BASE = 0x5851F42D4C957F2D


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case code point of each code point; 0 for ASCII white space."""
    kind, lower = np.zeros(_LAST + 1, np.uint8), np.arange(_LAST + 1, dtype=np.uint32)
    for code in range(_LAST):
        c = chr(code)
        if c.isalpha():
            small = c.lower()
            if len(small) == 1:
                lower[code] = ord(small)
            kind[code] = LETTER | (UPPER if c.isupper() else LOWER)
        elif c.isdigit():
            kind[code] = DIGIT
        elif c not in " \t\n\x0b\f\r":
            kind[code] = OTHER
    kind[_LAST] = OTHER
    return kind, lower


#: Scripts written without blanks between words: Thai and Lao, Burmese, Khmer, Han and kana.
_UNSPACED = [
    (0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3040, 0x3100), (0x31F0, 0x3200),
    (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, _LAST),
]


@cache
def _unspaced() -> np.ndarray:
    """Whether each code point is a letter of a script without blanks between words."""
    found = np.zeros(_LAST + 1, bool)
    for low, high in _UNSPACED:
        found[low:high] = True
    return found & ((_characters()[0] & LETTER) != 0)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(FLAT + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return tuple(out)


@dataclass
class Flat:
    """Neighbouring texts, or a stretch of a long one: kinds, lower-case codes, word bounds."""

    kind: np.ndarray
    code: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Sum of ``value`` over the characters of each word, modulo 2**64 for integers."""
        total = np.concatenate([np.zeros(1, value.dtype), np.cumsum(value, dtype=value.dtype)])
        return total[self.end] - total[self.start]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's lower-case code points."""
        power, inverse = _powers()
        n = len(self.code)
        return mix(self.sums((self.code.astype(np.uint64) + np.uint64(1)) * power[:n]) * inverse[self.start])


@dataclass
class Words:
    """Words of a list of texts: text ``i`` has the words from ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    columns: dict[str, np.ndarray]


def _stretches(texts: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
    """``joined, texts, places``: texts joined up to ``FLAT``; longer ones cut behind a blank."""
    parts, owners, places, at = [], [], [], 0
    for i, text in enumerate(texts):
        if at and at + len(text) >= FLAT:
            yield "\n".join(parts), owners, places
            parts, owners, places, at = [], [], [], 0
        start = 0
        while len(text) - start > FLAT:
            cut = text.rfind(" ", start, start + FLAT) + 1 or text.rfind("\n", start, start + FLAT) + 1 or start + FLAT
            yield text[start:cut], [i], [-start]
            start = cut
        parts.append(text[start:] if start else text)
        owners.append(i)
        places.append(at - start)
        at += len(text) - start + 1
    if parts:
        yield "\n".join(parts), owners, places


def words(
    texts: list[str], part: int, columns: Callable[[Flat], dict[str, np.ndarray]], letters: bool = False
) -> Words:
    """Maximal runs of characters of the kinds ``part``; ``columns`` gives arrays per word.

    With ``letters`` each letter of a script without blanks between words is a word by itself.
    Texts of any length are worked on in stretches of about a million characters.
    """
    kinds, lower = _characters()
    found: list[tuple[np.ndarray, ...]] = []
    extra: list[dict[str, np.ndarray]] = []
    for joined, owners, places in _stretches(texts):
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        code = np.minimum(code, _LAST)
        kind = kinds[code]
        inside = (kind & part) != 0
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        if letters and len(code) and code.max() >= _UNSPACED[0][0]:
            alone = _unspaced()[code] & inside
            border = inside[1:] & inside[:-1] & (alone[1:] | alone[:-1])
            within = np.nonzero(border)[0] + 1
            start, end = np.sort(np.concatenate([start, within])), np.sort(np.concatenate([end, within]))
        extra.append(columns(Flat(kind, lower[code], start, end)))
        places = np.array(places)
        begins = np.where(places < 0, 0, places)
        which = np.searchsorted(begins, start, side="right") - 1
        found.append((np.array(owners)[which], start - places[which], end - places[which]))
    if not found:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(len(texts) + 1, np.int64), empty, empty, {})
    owner, start, end = map(np.concatenate, zip(*found))
    joined_columns = {k: np.concatenate([e[k] for e in extra]) for k in extra[0]}
    return Words(np.searchsorted(owner, np.arange(len(texts) + 1)), start, end, joined_columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller ones, so that what is made of their texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def grouped(texts: list[str | None], chars: int = FLAT) -> Iterator[tuple[int, list[str]]]:
    """``at, texts``: neighbours of about ``chars`` characters; null is empty."""
    at, some, size = 0, [], 0
    for i, text in enumerate(texts):
        some.append(text or "")
        size += len(some[-1])
        if size >= chars:
            yield at, some
            at, some, size = i + 1, [], 0
    if some:
        yield at, some
