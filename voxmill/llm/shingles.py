"""Hashes of words and sets of word shingles, as numpy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pandas.util import hash_array

#: Words of a shingle.
SHINGLE = 5
_STEP = 0x9E3779B97F4A7C15


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash (SipHash with a fixed key) of each word."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    held = np.empty(len(words), dtype=object)
    held[:] = words
    return hash_array(held, categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of _STEP and of its inverse, modulo 2 ** 64."""
    inverse = pow(_STEP, -1, 2**64)
    return tuple(np.concatenate([[np.uint64(1)], np.full(count - 1, base, dtype=np.uint64)]).cumprod() for base in (_STEP, inverse))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` hashes: a polynomial of them, from the differences of one running sum."""
    count = max(0, len(hashes) - size + 1)
    if not count:
        return hashes[:0]
    up, down = _powers(max(1 << 14, 1 << (len(hashes) - 1).bit_length()))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * down[: len(hashes)])])
    return mixed((sums[size:] - sums[:-size]) * up[:count] + np.uint64(size))


def lowered_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; a short text has its whole sequence."""
    hashes = word_hashes(lowered_words(text))
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(SHINGLE, len(hashes))))
