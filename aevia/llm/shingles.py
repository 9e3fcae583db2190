"""Hashed words and shingles of whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (wraps silently)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``n`` words; with fewer words,
    of the whole sequence; of no words, none."""
    if not len(hashes):
        return hashes
    n_ = min(n, len(hashes))
    out = np.full(len(hashes) - n_ + 1, np.uint64(len(hashes) if len(hashes) < n else 0))
    for k in range(n_):
        out = mix(out * MIX + hashes[k: len(hashes) - n_ + 1 + k])
    return np.unique(out)
