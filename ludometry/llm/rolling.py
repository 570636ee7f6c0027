"""Prefix polynomial hashes over bytes, and what is found with them."""

from __future__ import annotations

from functools import cache

import numpy as np

# Texts are hashed in buffers of at most this many bytes; twice as many have a place.
BUFFER = 1 << 19
_BITS = 20
_PLACE = np.uint64((1 << _BITS) - 1)
_random = np.random.default_rng(100)
# Two codes for every byte value, and an odd base: hashes are taken modulo 2^64.
CODES = _random.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x2545F4914F6CDD1D


@cache
def _powers(inverse: bool = False) -> np.ndarray:
    """Powers of the base or of its inverse; made where hashes are taken, and only there."""
    out = np.full((1 << _BITS) + 1, pow(_BASE, -1, 1 << 64) if inverse else _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits, so that any of them may choose a partition or a minimum."""
    half, factor = np.uint64(32), np.uint64(0xD6E8FEB86659FD93)
    moved = values >> half
    out = values ^ moved
    out *= factor
    np.right_shift(out, half, out=moved)
    out ^= moved
    out *= factor
    np.right_shift(out, half, out=moved)
    out ^= moved
    return out


def prefix_hashes(data: np.ndarray, code: int = 0) -> np.ndarray:
    """The hash of each prefix of a buffer of bytes, the empty one included."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(CODES[code][data] * _powers()[: len(data)], out=out[1:])
    return out


def span_hashes(prefixes: np.ndarray, starts: np.ndarray, length) -> np.ndarray:
    """Hashes of the bytes [start, start + length); equal bytes have equal hashes."""
    return (prefixes[starts + length] - prefixes[starts]) * _powers(inverse=True)[starts]


def common_lengths(prefixes: np.ndarray, one: np.ndarray, other: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to ``most``, two suffixes share: by binary search on hashes."""
    low = np.zeros(len(one), dtype=np.int64)
    high = np.full(len(one), most, dtype=np.int64)
    same = span_hashes(prefixes, one, most) == span_hashes(prefixes, other, most)
    low[same] = most
    left = np.flatnonzero(~same)
    high[left] = most - 1
    while len(left):
        middle = (low[left] + high[left] + 1) >> 1
        a, b = one[left], other[left]
        same = span_hashes(prefixes, a, middle) == span_hashes(prefixes, b, middle)
        low[left] = np.where(same, middle, low[left])
        high[left] = np.where(same, high[left], middle - 1)
        left = left[low[left] < high[left]]
    return low


def window_minima(prefixes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed grams of a buffer, and for each window of ``length`` bytes the
    place of its smallest gram, the leftmost among equals.

    The place depends on the window's bytes alone, so equal windows choose alike.
    """
    count = len(prefixes) - gram
    grams = mix(span_hashes(prefixes, np.arange(count), gram))
    smallest = (grams & ~_PLACE) | np.arange(count, dtype=np.uint64)
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        smallest = np.minimum(smallest[:-size], smallest[size:])
        size *= 2
    if rest := width - size:
        smallest = np.minimum(smallest[:-rest], smallest[rest:])
    return grams, (smallest & _PLACE).astype(np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
