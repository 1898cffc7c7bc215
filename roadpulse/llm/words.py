"""Word hashes and word shingles of many texts at once.

Words are runs of ASCII letters and digits and of all other characters from U+0080 on, in
lower case. Hashes are 64 bits and the same on every machine.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Hashes are built in stretches of so many bytes, which bounds the memory of long texts.
_STRETCH = 1 << 20

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finalizer of a split-mix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class _Powers:
    up = _powers(_BASE, 1 << 12)
    down = _powers(_INVERSE, 1 << 12)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def _hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each run: a polynomial that does not depend on the place."""
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[:-1], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more at the end)."""
    encoded = [t.lower().encode() for t in texts]
    sizes = np.array([len(e) + 1 for e in encoded], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    hashes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        stop = int(np.searchsorted(ends, starts[i] + _STRETCH, side="right"))
        stop = max(stop, i + 1)
        low, high = int(starts[i]), int(ends[stop - 1])
        part = data[low:high].astype(np.uint64)
        hashes[i:stop] = _hash_runs(part, starts[i:stop] - low, ends[i:stop] - low)
        i = stop
    return hashes, np.searchsorted(starts, begins)


def shingles(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hash of every n consecutive words; places near the end reach into what follows."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    count = len(hashes) - n + 1
    total = np.zeros(count, np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * 0x2545F4914F6CDD1D % (1 << 64)
        total += hashes[i : i + count] * np.uint64(factor | 1)
    return mix(total)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for short arrays of integers faster than np.unique."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def shingle_sets(texts: list[str], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of each text.

    A text of fewer than n words has one shingle made of all of them; one without words none.
    """
    hashes, begins = word_hashes(texts)
    whole = shingles(hashes, n)
    sets = []
    for low, high in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if high - low >= n:
            sets.append(distinct(whole[low : high - n + 1]))
        elif high > low:
            sets.append(shingles(hashes[low:high], high - low))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
