"""Words and word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
#: An odd number and its inverse modulo 2^64: a word's hash does not depend on where it stands.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the output, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; for integers a sort is several times as fast as np.unique."""
    ordered = np.sort(values)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; a longer text makes them for itself, so that a worker keeps 16 MB."""
    global _powers
    if len(_powers[0]) >= size:
        return _powers
    found = tuple(np.cumprod(np.r_[np.uint64(1), np.full(max(size, 1 << 20), b, np.uint64)]) for b in (_BASE, _INVERSE))
    if size <= 1 << 20:
        _powers = found
    return found


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased, parted by \\x20 and \\x09 to \\x0D), and where each text's words begin and end."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = np.ones(len(data), bool)
    first[1:] = ~inside[:-1]
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(first & inside)
    last = np.ones(len(data), bool)
    last[:-1] = first[1:] | ~inside[1:]
    ends = np.flatnonzero(last & inside) + 1
    power, inverse = _tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words and where each text's runs begin and end; a shorter text is one run, if it has words."""
    counts = np.diff(edges)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(edges[:-1] - out[:-1], runs) + np.arange(out[-1])
    length = np.repeat(np.minimum(counts, size), runs)
    found = mix(length.astype(np.uint64))
    for k in range(size):
        more = k < length
        found[more] = mix(found[more] * _BASE + hashes[at[more] + k])
    return found, out
