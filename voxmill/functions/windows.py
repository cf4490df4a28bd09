"""64-bit hashes of runs of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

_ODD = 0x9E3779B97F4A7C15


def run_hashes(words: pa.Array, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words of one row of words: a polynomial, from one running sum."""
    coded = words.dictionary_encode()
    count = max(0, len(words) - n + 1)
    if not count:
        return np.zeros(0, dtype=np.uint64)
    distinct = np.empty(len(coded.dictionary), dtype=object)
    distinct[:] = coded.dictionary.to_pylist()
    hashes = hash_array(distinct, categorize=False)[coded.indices.to_numpy()]
    up, down = (np.concatenate([np.ones(1, dtype=np.uint64), np.full(len(words) - 1, base, dtype=np.uint64)]).cumprod() for base in (_ODD, pow(_ODD, -1, 2**64)))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * down)])
    return (sums[n:] - sums[:-n]) * up[:count]
