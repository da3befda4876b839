"""Windows of symbol sequences: rolling hashes, and families of neighbouring windows.

A window is ``length`` consecutive symbols of one sequence.  Inside each window the
``gram`` with the smallest hash is its anchor; equal windows have their anchors at
equal offsets.  Neighbouring windows with the same anchor are a family, about
``(length - gram) / 2`` windows, so whatever is asked of windows can first be
asked of families, a fraction of their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Odd multiplier of the rolling hash (modulo 2^64).  Its values pick anchors; sequences can
#: be made that share them, so they never decide whether windows are equal.
BASE = 0x9E3779B97F4A7C15
_BIT = np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of a base and of its inverse modulo 2^64, made longer when asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n += n // 4
            one = np.full(n, self.base, np.uint64)
            one[:1] = 1
            self.up = np.cumprod(one)
            one[1:] = self.inverse
            self.down = np.cumprod(one)
        return self.up, self.down


class Rolling:
    """Hashes of any run of symbols in constant time each."""

    def __init__(self, symbols: np.ndarray, powers: Powers):
        n = len(symbols)
        up, self.down = powers.upto(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start])

    def every(self, length: int) -> np.ndarray:
        """The hash of each run of ``length`` symbols."""
        n = max(0, len(self.sums) - length)
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


@dataclass
class Families:
    """Families of neighbouring windows, in order of their places.

    ``low`` and ``high`` are the first and last start of a window, ``anchor`` the start
    of the common gram, ``core`` its hash.
    """

    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    core: np.ndarray

    def __getitem__(self, some) -> Families:
        return Families(self.low[some], self.high[some], self.anchor[some], self.core[some])


def families(roll: Rolling, borders: np.ndarray, length: int, gram: int) -> Families:
    """All windows inside the sequences that ``borders`` (n + 1 places) cut, by family."""
    none = np.zeros(0, np.int64)
    n = len(roll.sums) - 1
    if n < length:
        return Families(none, none, none, none.astype(np.uint64))
    grams = roll.every(gram)
    place = np.arange(len(grams), dtype=np.uint64)
    # The gram's hash above, its place below: equal hashes are decided by the place.
    low_bits = np.uint64(max(1, int(len(grams)).bit_length()))
    least = sliding_least((grams >> low_bits << low_bits) | place, length - gram + 1)
    anchor = (least & ((_BIT << low_bits) - _BIT)).astype(np.int64)
    size = np.diff(borders)
    count = np.maximum(size - length + 1, 0)
    start = np.repeat(borders[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    if not len(start):
        return Families(none, none, none, none.astype(np.uint64))
    own = anchor[start]
    first = np.ones(len(start), bool)
    first[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(start)) - 1
    return Families(start[at], start[last], own[at], grams[own[at]])
