"""Polynomial window hashes and minimizer runs over arrays of 64-bit symbols (NumPy).

All sums wrap modulo 2^64. ``B`` is odd, so it has an inverse, and the hash of any slice follows
from two prefix sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    known = _tables.get(base)
    if known is None or len(known[0]) < n:
        size = max(4096, 2 * n)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _tables[base] = known = (both[0], both[1])
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each hash, so that its order says nothing about the symbols."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hashes of slices of one symbol array."""

    def __init__(self, symbols: np.ndarray, base: int = BASES[0]):
        self.n = len(symbols)
        power, self.inverse = _powers(self.n + 1, base)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(symbols * power[: self.n], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start]
                   + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """The hash of every slice of ``k`` symbols."""
        count = self.n - k + 1
        return mix((self.sums[k:] - self.sums[:count]) * self.inverse[:count] + np.uint64(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, in three passes whatever the width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def ordered(grams: np.ndarray) -> np.ndarray:
    """Keys whose minimum is the smallest hash and, among equal hashes, the rightmost."""
    return (grams & _HIGH) | (_LOW - np.arange(len(grams), dtype=np.uint64))


@dataclass(frozen=True)
class Runs:
    """Maximal runs of consecutive windows that choose the same ``k``-gram.

    ``seed`` is that gram's hash, ``start`` the first window, ``count`` the windows and ``context``
    the hash of all symbols they cover. Equal windows choose equal grams at the same offset.
    """

    seed: np.ndarray
    context: np.ndarray
    start: np.ndarray
    count: np.ndarray


def runs(prefix: Prefix, window: int, k: int, first: int = 0, windows: int | None = None) -> Runs:
    """The runs among ``windows`` windows from ``first`` on (all of them by default)."""
    if windows is None:
        windows = prefix.n - window + 1 - first
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none.astype(np.uint64), none.astype(np.uint64), none, none)
    last = first + windows + window - k  # grams that these windows hold
    begin = np.arange(first, last)
    grams = prefix.slices(begin, begin + k) if windows < prefix.n - window + 1 else prefix.grams(k)
    lowest = sliding_min(ordered(grams), window - k + 1)
    chosen = (_LOW - (lowest & _LOW)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    count = np.diff(np.append(heads, windows))
    start = heads + first
    context = prefix.slices(start, start + count - 1 + window)
    return Runs(grams[chosen[heads]], context, start, count)
