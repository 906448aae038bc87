"""Words and word windows of whole texts, vectorized for Arrow batches.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r
(``[^\\x20\\x09-\\x0D]+``); in UTF-8 these bytes never occur inside another
character, so words of the bytes are the words of the text.  Hashes are
64-bit polynomial hashes modulo 2**64 with random byte codes and a final mix;
two different seeds give two independent hashes.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (xor-shift-multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Hasher:
    """Hashes of words and of windows of ``k`` words, for one seed."""

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(7_919 + seed))
        self.codes = rng.integers(1, 2 ** 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1, 2 ** 62)) * 2 + 1
        self._up = np.ones(1, dtype=_U)
        self._down = np.ones(1, dtype=_U)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, 2 * len(self._up), 1 << 16)
            for name, b in (("_up", self.base), ("_down", pow(self.base, -1, 2 ** 64))):
                p = np.full(size, b, dtype=_U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self._up[:n], self._down[:n]

    def ranges_of(self, data: np.ndarray):
        """Function (starts, ends) -> hashes of these stretches of ``data``."""
        up, down = self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(self.codes[data] * up[:-1], out=sums[1:])
        return lambda starts, ends: mix((sums[ends] - sums[starts]) * down[starts])

    def _ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for every pair."""
        if not len(starts):
            return np.zeros(0, dtype=_U)
        up, down = self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every word data[start:end] (its length is mixed in)."""
        h = self._ranges(self.codes[data], starts, ends)
        return mix(h + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))

    def windows(self, word_hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of word_hashes[i:i+k] for every i that has k words."""
        n = len(word_hashes) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=_U)
        at = np.arange(n)
        return self._ranges(word_hashes, at, at + k)


def spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends) of one text."""
    data = np.frombuffer(text, dtype=np.uint8)
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return data, none, none
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return data, edges[0::2], edges[1::2]


def minimizers(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the smallest hash (leftmost of ties) of some ``w``
    consecutive entries; two equal stretches of ``w`` entries share theirs."""
    return np.unique(minimizer_of_each(hashes, w))


def minimizer_of_each(hashes: np.ndarray, w: int) -> np.ndarray:
    """For every start i with ``w`` entries, the position of the smallest
    (leftmost of ties) of hashes[i:i+w]; doubling over window lengths."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, size = np.arange(len(hashes)), 1
    while size < w:
        step = min(size, w - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(hashes[right] < hashes[left], right, left)
        size += step
    return best
