"""Recompression of word sequences: names of runs and pairs, round by round.

A round names every maximal run of one symbol, then splits the symbols by a
hash bit into left and right and names every left symbol with a right symbol
after it. A name is a hash of what it stands for, so it is the same in every
document and on every machine without a dictionary.

Each symbol carries its extent: the range of words that its being there
depends on (its own words and the neighbours that were looked at). Wherever
a word range recurs, the symbols with their extent inside it recur too. A
window of words therefore has an anchor that any document with the same
window finds as well: of the symbols whose extent lies in the window those
of the highest round, of these the one with the least hash, of equals the
first. The anchor's name covers all words of its extent.

All documents of a batch are handled as one sequence with separators.
"""

from __future__ import annotations

import numpy as np

from aevia.llm.shingles import MIX, mix

ROUNDS = 4
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_2 = np.uint64(0xA0761D6478BD642F)
_INVERSE, _INVERSE_2 = (np.uint64(pow(int(b), -1, 1 << 64)) for b in (_BASE, _BASE_2))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


class RangeHashes:
    """Hashes of word ranges, from prefix sums (all modulo 2**64)."""

    def __init__(self, words: np.ndarray, second: bool = False):
        base, inverse = (_BASE_2, _INVERSE_2) if second else (_BASE, _INVERSE)
        w = mix(words + MIX) if second else words
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * _powers(base, len(w)), dtype=np.uint64)))
        self.back = _powers(inverse, len(w) + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin])


class Batch:
    """Word hashes of several documents: ``words`` with a separator before,
    between and after them; document i is ``words[begin[i]:end[i]]``."""

    def __init__(self, docs: list[np.ndarray]):
        counts = np.array([len(d) for d in docs], np.int64)
        self.end = np.cumsum(counts + 1)
        self.begin = self.end - counts
        self.words = np.zeros(int(counts.sum()) + len(docs) + 1, np.uint64)
        self.separator = np.ones(len(self.words), bool)
        inside = np.repeat(self.begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        if len(inside):
            self.words[inside] = np.concatenate(docs)
            self.separator[inside] = False

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start of every window of ``size`` words, and its document."""
        n = np.maximum(self.end - self.begin - size + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        return np.repeat(self.begin - (np.cumsum(n) - n), n) + np.arange(n.sum()), doc


def rounds(batch: Batch, number: int = ROUNDS):
    """``(symbols, low, high)`` of each round, the words themselves first;
    the extent of a symbol is ``[low, high)``."""
    sym, sep = batch.words, batch.separator
    low = np.arange(len(sym))
    high = low + 1
    yield sym, low, high, sep
    for r in range(number):
        # runs
        first = np.append(True, (sym[1:] != sym[:-1]) | sep[1:] | sep[:-1])
        at = np.flatnonzero(first)
        length = np.diff(at, append=len(sym))
        last = at + length - 1
        name = sym[at]
        long_ = length > 1
        name[long_] = mix(name[long_] * MIX + length[long_].astype(np.uint64) + np.uint64(r << 40))
        # a run ends where its neighbours differ: it depends on one symbol on either side
        sep, low, high = sep[at], low[np.maximum(at - 1, 0)], high[np.minimum(last + 1, len(sep) - 1)]
        # pairs: a left symbol looks at the next one, a right symbol at the one before
        left = (mix(name + np.uint64(2 * r + 1)) >> np.uint64(63)).astype(bool) & ~sep
        pair = np.append(left[:-1] & ~left[1:] & ~sep[1:], False)
        second = np.append(False, pair[:-1])
        next_high, prev_low = np.append(high[1:], high[-1:]), np.append(low[:1], low[:-1])
        sym = name.copy()
        sym[pair] = mix(mix(name[pair] + MIX) + name[np.flatnonzero(pair) + 1])
        low = np.where(left, low, prev_low)[~second]
        high = np.where(left, next_high, high)[~second]
        sym, sep = sym[~second], sep[~second]
        yield sym, low, high, sep


def _first_least(value: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the first least value in each ``[begin, end)`` (not empty)."""
    out = np.empty(len(begin), np.int64)
    span = np.frexp((end - begin).astype(np.float64))[1] - 1  # floor of log2
    best = np.arange(len(value))
    for k in range(int(span.max(initial=0)) + 1):
        at = np.flatnonzero(span == k)
        if len(at):
            a, b = best[begin[at]], best[end[at] - (1 << k)]
            out[at] = np.where(value[b] < value[a], b, a)
        a, b = best[: -(1 << k)], best[1 << k:]
        best = np.where(value[b] < value[a], b, a)
    return out


def anchors(batch: Batch, starts: np.ndarray, size: int, number: int = ROUNDS) -> np.ndarray:
    """Name of the anchor of each window."""
    names = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return names
    hashes = RangeHashes(batch.words)
    open_ = np.arange(len(starts))
    n = len(batch.words)
    for level, (sym, low, high, sep) in reversed(list(enumerate(rounds(batch, number)))):
        ok = ~sep
        sym, low, high = sym[ok], low[ok], high[ok]
        # symbols with low < p and with high <= p, for every place p
        before = np.concatenate(([0], np.cumsum(np.bincount(low, minlength=n + 1))))
        within = np.cumsum(np.bincount(high, minlength=n + 1))
        p = starts[open_]
        a, b = before[p], within[p + size]
        has = a < b
        w, a, b = open_[has], a[has], b[has]
        # neighbouring windows mostly ask for the same range
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
        chosen = _first_least(mix(sym + MIX), a[new], b[new])
        name = mix(hashes.of(low[chosen], high[chosen]) + sym[chosen] + np.uint64(level))
        names[w] = name[np.cumsum(new) - 1] if len(a) else name
        open_ = open_[~has]
        if not len(open_):
            break
    return names
