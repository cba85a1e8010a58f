"""The binary (23, 12) Golay code: nearest codeword, and all codewords near a word.

The code is perfect: each 23-bit word is within three bits of exactly one
codeword. Words of which that distance is two or less have the same nearest
codeword as all their one-bit neighbours; a word at distance three has five
more codewords among its neighbours' nearest ones, six in all.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # fixed value: generator polynomial of the code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BITS, DATA = 23, 12


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each 11-bit syndrome, the error pattern and the up to six patterns that lead to a codeword
    nearest to the word or a one-bit neighbour."""
    patterns = np.array([sum(1 << p for p in places) for n in range(4) for places in combinations(range(BITS), n)])
    error = np.zeros(len(patterns), np.int64)
    error[_syndrome(patterns)] = patterns
    # the codeword of the neighbour w ^ bit is (w ^ bit) ^ error(neighbour), so w ^ (bit ^ error)
    bits = 1 << np.arange(BITS)
    flips = error[_syndrome(error[:, None] ^ bits)] ^ bits
    near = np.full((len(error), 6), -1, np.int64)
    for s, all_of in enumerate(np.concatenate([error[:, None], flips], axis=1).tolist()):
        own = list(dict.fromkeys(all_of))
        near[s, :len(own)] = own
    return error, near


@lru_cache(1)
def _halves() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the lower and upper bits of a word; the syndrome is linear, so the two add up."""
    half = np.arange(1 << DATA)
    return _syndrome(half), _syndrome(half[:1 << (BITS - DATA)] << DATA)


def syndromes(words: np.ndarray) -> np.ndarray:
    low, high = _halves()
    return low[words & ((1 << DATA) - 1)] ^ high[words >> DATA]


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of the polynomial ``word`` by the generator."""
    rest = word.astype(np.int64)
    for bit in range(BITS - 1, BITS - DATA - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - (BITS - DATA))), rest)
    return rest


def nearest(words: np.ndarray) -> np.ndarray:
    """12-bit index (the codeword's upper bits) of the codeword nearest to each 23-bit word."""
    error, _ = tables()
    return (words ^ error[syndromes(words)]) >> (BITS - DATA)


def neighbours(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords nearest to each word and its one-bit neighbours, -1 beyond the last; six columns."""
    _, near = tables()
    pattern = near[syndromes(words)]
    return np.where(pattern < 0, -1, (words[:, None] ^ pattern) >> (BITS - DATA))
