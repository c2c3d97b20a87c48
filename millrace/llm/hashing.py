"""Hashes of words and byte strings, for whole arrays at once.

A stretch of bytes is hashed as a polynomial over random 64-bit values of its bytes, modulo 2**64; prefix sums give the hash
of any stretch with one subtraction and one product.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_VALUES = np.random.Generator(np.random.PCG64(20240115)).integers(0, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, np.ndarray] = {}

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, *range(9, 14)]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 … base ** n, kept for the next call."""
    known = _powers.get(int(base))
    if known is None or len(known) <= n:
        size = max(n + 1, 1 << 16)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 16 << 20:
            _powers[int(base)] = known
    return known[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values[i] * base ** i before each place."""
    made = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, len(values))[: len(values)], dtype=np.uint64, out=made[1:])
    return made


def byte_sums(data: np.ndarray, kind: int = 0) -> np.ndarray:
    """prefix_sums of bytes; ``kind`` 0 and 1 are independent."""
    return prefix_sums(_VALUES[kind][data])


def stretch_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[starts:ends] for arrays of places."""
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(sums) - 1)[starts] + (ends - starts).astype(np.uint64))


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other with a line feed in between, and where each begins (and the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return data, begins


def find_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches without separators."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~SEPARATORS[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its least one, the leftmost of equals."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    # least of runs of 1, 2, 4 … values, then of two runs that overlap
    best, place, size = values, np.arange(len(values)), 1
    while size * 2 <= width:
        left, right = best[:-size], best[size:]
        take = right < left
        place = np.where(take, place[size:], place[:-size])
        best = np.where(take, right, left)
        size *= 2
    shift = width - size
    if shift:
        left, right = best[:n], best[shift : shift + n]
        return np.where(right < left, place[shift : shift + n], place[:n])
    return place[:n]
