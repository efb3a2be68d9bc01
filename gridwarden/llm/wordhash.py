"""Vectorised hashes of the words of many texts at once (inside tasks)."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``data[start:end]``, by running sums of a polynomial in ``BASE``."""
    n = int(len(data))
    powers = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((mix(data.astype(np.uint64) + np.uint64(1))) * powers[:n], out=sums[1:])
    inside = (sums[ends] - sums[starts]) * _inverse_powers(n)[starts]
    return mix(inside + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def _grown(table: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    if len(table) > n:
        return table
    size = 1 << (n + 1).bit_length()
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _powers(n: int) -> np.ndarray:
    global _up
    _up = _grown(_up, BASE, n)
    return _up


def _inverse_powers(n: int) -> np.ndarray:
    global _down
    _down = _grown(_down, np.uint64(pow(int(BASE), -1, 1 << 64)), n)
    return _down


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(text: str) -> np.ndarray:
    """Hashes of a text's words: runs without blanks, A-Z in lower case, other letters as they are."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)  # bytes: only A-Z change
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return spans_hash(data, starts, ends)
