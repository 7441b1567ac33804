"""A minimal perfect hash in arrays: levels of bit sets, each for the keys that met before."""

from __future__ import annotations

import numpy as np

#: Bits of a level for each of its keys.
GAMMA = 2
LEVELS = 64

_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(high + mix(low ^ np.uint64(level))) % np.uint64(size)


def build(high: np.ndarray, low: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays for distinct 128-bit keys: ``sizes`` of the levels, ``words`` of bits, ``ranks``."""
    sizes, words = [], []
    level = 0
    while len(high):
        if level == LEVELS:
            raise ValueError("the keys are not distinct")
        size = 64 * -(-GAMMA * len(high) // 64)
        place = _places(high, low, level, size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        meets = ~alone[place]
        high, low, level = high[meets], low[meets], level + 1
    bits = np.concatenate([*words, np.zeros(0, "<u8")])
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])
    return {"sizes": np.array(sizes, np.int64), "words": bits, "ranks": ranks[:-1] if len(bits) else ranks[:0]}


def probe(arrays: dict[str, np.ndarray], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Index of each key from 0 to n - 1; for other keys any index, or -1."""
    out = np.full(len(high), -1, dtype=np.int64)
    left, base = np.arange(len(high)), 0
    for level, size in enumerate(arrays["sizes"].tolist()):
        if not len(left):
            break
        place = _places(high[left], low[left], level, size).astype(np.int64)
        word, bit = base // 64 + place // 64, (place % 64).astype(np.uint64)
        bits = arrays["words"][word]
        hit = (bits >> bit) & _ONE == 1
        below = bits[hit] & ((_ONE << bit[hit]) - _ONE)
        out[left[hit]] = arrays["ranks"][word[hit]] + np.bitwise_count(below)
        left, base = left[~hit], base + size
    return out
