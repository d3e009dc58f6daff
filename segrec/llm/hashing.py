"""64-bit hashes of words, shingles and windows, vectorised per document."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
# Odd multipliers: fixed arbitrary values.
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    one = xxhash.xxh3_64_intdigest
    return np.array([one(w) for w in words], dtype=_U)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of MurmurHash3)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class Windows:
    """Hashes of all runs of ``width`` consecutive words, by running sums of a polynomial mod 2^64."""

    def __init__(self, width: int, lane: int = 0):
        self.width, step = width, _STEPS[lane]
        self._step, self._back = step, pow(step, -1, 1 << 64)
        self._powers = self._inverse = np.ones(1, dtype=_U)

    def _grow(self, n: int) -> None:
        size = max(1024, 1 << (n - 1).bit_length())
        for name, factor in (("_powers", self._step), ("_inverse", self._back)):
            table = np.full(size, factor, dtype=_U)
            table[0] = 1
            setattr(self, name, np.cumprod(table, dtype=_U))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if n < self.width:
            return np.zeros(0, dtype=_U)
        if n > len(self._powers):
            self._grow(n)
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(hashes * self._powers[:n], dtype=_U)))
        return mix((sums[self.width:] - sums[:-self.width]) * self._inverse[:n - self.width + 1])


def shingle_set(hashes: np.ndarray, windows: Windows) -> np.ndarray:
    """Distinct shingle hashes, ascending; a shorter sequence is one shingle, no word none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=_U)
    if n < windows.width:
        whole = _U(n)
        for h in hashes:
            whole = mix(np.array([whole ^ h], dtype=_U))[0]
        return np.array([whole], dtype=_U)
    return np.unique(windows(hashes))


__all__ = ["Windows", "mix", "shingle_set", "word_hashes"]
