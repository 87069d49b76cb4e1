"""Word shingles, MinHash values and the pruning rule of a Bayesian similarity search, in numpy."""

from __future__ import annotations

from math import comb

import numpy as np

#: Values of a signature, values of a band, values compared at once.
VALUES, BAND, STEP = 128, 4, 16
_WORD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed at once; longer texts go alone.
SLAB_BYTES = 1 << 19

_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if len(_up) < n:
        size = max(n, SLAB_BYTES + (SLAB_BYTES >> 2))
        tables = []
        for base in (int(_WORD), pow(int(_WORD), -1, 1 << 64)):
            t = np.full(size, np.uint64(base), np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _up, _down = tables
    return _up, _down


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of the maximal runs of bytes outside the blanks 0x20 and 0x09-0x0D."""
    n = len(data)
    seen = np.zeros(n + 2, bool)
    seen[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edge = np.flatnonzero(seen[1:] != seen[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5):
    """The sorted distinct shingle hashes of every text in turn.

    A text of fewer than ``width`` words, but at least one, is a single shingle; one without words has none.
    """
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLAB_BYTES, "right")) - 1)
        lo = offsets[row]
        # A blank after every text keeps words of two texts apart.
        sizes = np.diff(offsets[row : last + 1])
        spaced = np.insert(data[lo : offsets[last]], offsets[row + 1 : last + 1] - lo, 0x20)
        edges = np.concatenate([[0], np.cumsum(sizes + 1)])
        start, _, hashes = words(spaced)
        first = np.searchsorted(start, edges)
        total = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for j in range(width):
            total = (total ^ hashes[j : j + len(total)]) * _MIX1 + _WORD
        total = mix(total)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(total[a : b - width + 1])
            elif b > a:
                one = np.array([b - a], np.uint64)
                for k in range(a, b):
                    one = (one ^ hashes[k : k + 1]) * _MIX1 + _WORD
                yield mix(one)
            else:
                yield np.empty(0, np.uint64)
        row = last


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values; ``shingles`` must not be empty."""
    low = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(shingles), 1024):
        part = (shingles[at : at + 1024, None] * _FACTORS) >> np.uint64(32)
        low = np.minimum(low, part.min(0).astype(np.uint32))
    return low


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key for each band of a signature; the number of the band is part of it."""
    parts = values.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(parts), dtype=np.uint64)
    for j in range(BAND):
        key = mix((key ^ parts[:, j]) * _WORD + _MIX1)
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float, values: int = VALUES, step: int = STEP) -> dict[int, int]:
    """After how many values how many must match.

    With a uniform prior on the similarity s, the posterior after c of m matches is Beta(c + 1, m - c + 1), and
    P(s >= t) is the chance of at most c successes in m + 1 draws of chance t. A pair goes on while that is at
    least ``tolerance``.
    """
    out = {}
    for m in range(step, values + 1, step):
        tail, c = 0.0, 0
        while True:
            tail += comb(m + 1, c) * threshold**c * (1 - threshold) ** (m + 1 - c)
            if tail >= tolerance or c > m:
                break
            c += 1
        out[m] = c
    return out


def survivors(a: np.ndarray, b: np.ndarray, rule: dict[int, int]) -> np.ndarray:
    """Rows of two aligned signature tables that keep a chance: values are compared step by step."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for m, least in rule.items():
        matches = matches + (a[alive, done:m] == b[alive, done:m]).sum(1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], m
    return alive


def reaches(common: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether |A ∩ B| / |A ∪ B| is at least the threshold; the quotient is rounded once."""
    return common / (a + b - common) >= threshold
