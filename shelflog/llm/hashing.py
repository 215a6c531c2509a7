"""Vectorised 64-bit hashes of spans: prefix sums of a polynomial, and minimum anchors."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
# Spans are hashed modulo a prime. A power of two would not do: texts built by repeated
# complementing (Thue-Morse words) agree modulo 2**64 under every base.
_PRIME = (1 << 61) - 1
_P, _LOW31, _LOW30 = np.uint64(_PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, from halves of 31 bits."""
    a1, a0 = a >> np.uint64(31), a & _LOW31
    b1, b0 = b >> np.uint64(31), b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced((a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + a0 * b0)


def _sums(x: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime; high and low halves are summed apart."""
    high = _reduced(np.cumsum(x >> np.uint64(32), dtype=np.uint64))
    low = _reduced(np.cumsum(x & np.uint64(0xFFFFFFFF), dtype=np.uint64))
    return _reduced(_times(high, np.uint64(1 << 32)) + low)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    have = 1
    while have <= n:
        more = min(have, n + 1 - have)
        out[have : have + more] = _times(out[:more], np.uint64(pow(base, have, _PRIME)))
        have += more
    return out


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            base = _BASE % _PRIME
            self.up, self.down = _powers(base, size), _powers(pow(base, -1, _PRIME), size)
        return self.up, self.down


class Spans:
    """Hashes of any spans of a sequence of 64-bit symbols, from one prefix sum."""

    def __init__(self, symbols: np.ndarray, powers: Powers):
        up, self.down = powers.get(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        self.sums[1:] = _sums(_times(_reduced(symbols), up[: len(symbols)]))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        between = self.sums[end] + (_P - self.sums[start])
        value = _times(np.where(between >= _P, between - _P, between), self.down[start])
        return mix(value + (end - start).astype(np.uint64) * np.uint64(_BASE))


def word_hashes(raw: np.ndarray, letter: np.ndarray, powers: Powers, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the maximal runs of ``letter`` in ``raw`` (bytes).

    ``symbol`` maps a byte to its 64-bit symbol.
    """
    padded = np.zeros(len(letter) + 2, np.int8)
    padded[1:-1] = letter
    step = np.diff(padded)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return start, end, Spans(symbol[raw], powers).hash(start, end)


def symbols(seed: int = 0) -> np.ndarray:
    """256 64-bit numbers, one per byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` consecutive grams the position of the least, the first of equals.

    The choice depends on the window's content alone, so equal windows choose alike. Hash and
    position stand in one number, so a running minimum by doubling carries both.
    """
    out = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    if rest:
        out = np.minimum(out[:-rest], out[rest:])
    return (out & np.uint64(0xFFFFFFFF)).astype(np.int64)
