"""Keys of nearby codewords of the binary Golay code [23, 12, 7], for hashing words with errors."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, DATA = 23, 12
CHECK = LENGTH - DATA

#: Fixed value: a generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits, and for each remainder its error patterns up to weight 4.

    The code is perfect: one pattern of weight 3 or less per remainder, here in column 0.  The
    patterns of weight 4 all belong to remainders whose first pattern has weight 3, five to each.
    """
    upper = np.array([_remainder(i << CHECK) for i in range(1 << DATA)], dtype=np.int64)
    patterns: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            patterns[_remainder(error)].append(error)
    table = np.full((1 << CHECK, max(map(len, patterns))), -1, dtype=np.int64)
    for i, errors in enumerate(patterns):
        table[i, : len(errors)] = errors
    return upper, table


def nearby(words: np.ndarray) -> np.ndarray:
    """Indices of all codewords within distance 4 of each 23-bit word: 1 or 6 of them, else -1.

    Column 0 is the nearest codeword.  Words at distance 1 share a key: the nearest codeword of
    one is within 3 + 1 of the other.
    """
    upper, table = _tables()
    words = words.astype(np.int64)
    errors = table[upper[words >> CHECK] ^ (words & ((1 << CHECK) - 1))]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK)
