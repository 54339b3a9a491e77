"""64-bit hashes of runs of bytes (words, n-grams), computed for many texts at once with numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

RADIX = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INVERSE = pow(RADIX, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(RADIX))


@lru_cache(maxsize=1)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(count, RADIX, np.uint64)
    down = np.full(count, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def merged(*places: np.ndarray) -> np.ndarray:
    """Ordered places together, each once."""
    found = np.sort(np.concatenate(places), kind="stable")  # merges stretches that are ordered already
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def run_bounds(keep: np.ndarray, bounds: np.ndarray = np.zeros(0, np.int64)) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true values that no place of ``bounds`` cuts."""
    edges = np.flatnonzero(np.diff(keep.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    inside = bounds[(bounds > 0) & (bounds < len(keep))]
    cuts = merged(inside[keep[inside - 1] & keep[inside]])
    starts, ends = edges[::2], edges[1::2]
    return (merged(starts, cuts), merged(ends, cuts)) if len(cuts) else (starts, ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, whatever its place in ``data``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = np.take(BYTE_VALUES, data, out=sums[1:], mode="clip")
    values *= up[: len(data)]
    np.cumsum(values, out=values)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` successive words; with fewer words, of the whole sequence; none without words."""
    count = len(words)
    if not count:
        return np.empty(0, np.uint64)
    width = min(size, count)
    total = np.full(count - width + 1, width, np.uint64)
    for place in range(width):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= words[place : place + count - width + 1]
        total = mix(total)
    return total
