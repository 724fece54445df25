"""Words of many texts at once: where they are, and a 64-bit hash of each."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = (np.uint64(30), np.uint64(27), np.uint64(31))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: A random number per byte, and powers of the base and of its inverse, as far as needed so far.
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes that are hashed at once.
STEP = 1 << 22

#: Bytes that separate words at white space, and those outside words of letters and digits.
SPACES = np.isin(np.arange(256), [32, *range(9, 14)])
LETTERS = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible structure."""
    x = x + _ODD
    x = (x ^ (x >> _SHIFT[0])) * _MIX[0]
    x = (x ^ (x >> _SHIFT[1])) * _MIX[1]
    return x ^ (x >> _SHIFT[2])


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS


def spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of bytes for which ``inside`` holds."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = inside[data]
    first = word[1:-1] & ~word[:-2]
    last = word[1:-1] & ~word[2:]
    edges = bounds[:-1][bounds[:-1] < bounds[1:]]  # first bytes of texts that aren't empty
    first[edges] = word[1:-1][edges]
    last[edges[1:] - 1] = word[1:-1][edges[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span (in order); equal bytes have equal hashes wherever they are."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # so many spans at once as lie within STEP bytes, or one
        low = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, low + STEP, "right")))
        part = data[low : int(ends[upto - 1])]
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
        a, b = starts[at:upto] - low, ends[at:upto] - low
        out[at:upto] = mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        at = upto
    return out


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes."""
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + words[j : j + n]
    return mixed(total)
