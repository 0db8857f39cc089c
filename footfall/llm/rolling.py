"""Word spans and rolling hashes of many texts at once, in numpy.

A prefix sum of byte values times powers of an odd number gives the hash of any
span by one subtraction and one multiplication, so words, lines and n-grams of
every length come from the same sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 64, (2, 256), np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
_GRAM = 0xD1342543DE82EF95 | 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    kept = _powers.get(base)
    if kept is None or kept.shape[1] < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        kept = np.empty((2, size), np.uint64)
        for row, factor in zip(kept, (base, inverse), strict=True):
            row[0] = 1
            done = 1
            while done < size:  # doubling: the powers so far times the next one
                step = np.uint64(pow(factor, done, 1 << 64))
                more = min(done, size - done)
                row[done : done + more] = row[:more] * step
                done += more
        if size <= 1 << 22:
            _powers[base] = kept
    return kept[0][:n], kept[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def byte_sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums for ``span_hashes``; ``which`` (0 or 1) names one of two independent hashes."""
    return prefix_sums(_BYTE[which][data], _BASE[which])


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    _, down = powers(_BASE[which], len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
    """(starts, ends, text number) of every run of bytes outside ``gap``."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    inside = ~gap[data]
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    edges = offsets[1:-1]
    first[edges[edges < len(data)]] = True
    last = np.empty(len(data), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[edges[edges > 0] - 1] = True
    starts = np.flatnonzero(inside & first)
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def gram_sums(words: np.ndarray) -> np.ndarray:
    return prefix_sums(words, _GRAM)


def gram_hashes(sums: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of n words inside one text."""
    count = len(doc) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(doc[:count] == doc[n - 1 :])
    _, down = powers(_GRAM, len(sums))
    return at, mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n))


def sequence_hash(sums: np.ndarray, first: int, last: int) -> np.ndarray:
    """The hash of the words from ``first`` to before ``last``, as an array of one."""
    _, down = powers(_GRAM, len(sums))
    return mix((sums[last : last + 1] - sums[first : first + 1]) * down[first] + np.uint64(last - first))


def per_text(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))


def repeated(keys: np.ndarray, keep: str | bool = False) -> np.ndarray:
    """Which keys appear more than once (``keep=False``) or earlier (``keep="first"``)."""
    return pd.Series(keys).duplicated(keep=keep).to_numpy()


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that starts in ``at``."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, at, 1)
    np.subtract.at(depth, at + n, 1)
    return np.cumsum(depth[:-1]) > 0


def sums_of(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of ``values`` between successive offsets, also of empty stretches."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
