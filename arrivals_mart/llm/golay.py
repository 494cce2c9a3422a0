"""The perfect binary Golay code [23, 12, 7], vectorised.

Every 23-bit word lies within three bits of exactly one codeword. A codeword
is named by its upper 12 bits, which determine it (the code is cyclic, so any
12 neighbouring positions are an information set).
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
#: Fixed value of the code: the generator x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each bit, and the error pattern of each syndrome."""
    bit = []
    value = 1
    for _ in range(BITS):
        bit.append(value)
        value <<= 1
        if value >> 11:
            value ^= GENERATOR
    error = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(BITS), weight):
            syndrome = 0
            for p in places:
                syndrome ^= bit[p]
            error[syndrome] = sum(1 << p for p in places)
    return np.array(bit, np.int64), error


def syndromes(words: np.ndarray) -> np.ndarray:
    bit, _ = _tables()
    out = np.zeros(len(words), np.int64)
    for i in range(BITS):
        out ^= ((words >> i) & 1) * bit[i]
    return out


def nearest(words: np.ndarray) -> np.ndarray:
    """Index of the codeword next to each word."""
    _, error = _tables()
    return (words ^ error[syndromes(words)]) >> 11


def nearby(words: np.ndarray, width: int) -> np.ndarray:
    """Indices of the codewords next to any word that differs in at most one
    of the lower ``width`` bits: a row per word, sorted, with repeats set to -1.

    Two words that differ in one bit share ``nearest`` of one with ``nearby``
    of the other; two that differ in two bits share a value of ``nearby``
    (that of the word half way).
    """
    bit, error = _tables()
    flips = np.concatenate([[0], 1 << np.arange(width)])
    changed = np.concatenate([[0], bit[:width]])
    found = (words[:, None] ^ flips ^ error[syndromes(words)[:, None] ^ changed]) >> 11
    found.sort(axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
