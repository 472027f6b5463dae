"""Rolling hashes of bytes and words, vectorised over a whole run of documents."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes hashed at a time; a longer word or document is taken whole.
SEGMENT = 1 << 19

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the power 0 … n - 1, modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if len(have) <= 4 * SEGMENT:
            _powers[int(base)] = have
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums from which :func:`between` takes the hash of any run of ``values``."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the run from ``start`` to ``end``; it doesn't depend on where the run lies."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])


def rolling(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return mix((sums[width:] - sums[:n]) * powers(INVERSE, n))


def word_hashes(words: bytes) -> np.ndarray:
    """One hash per word of a text whose words are separated by one space each."""
    found = []
    at = 0
    while at < len(words):
        end = len(words)
        if end - at > SEGMENT:
            cut = words.find(b" ", at + SEGMENT)
            end = cut if cut >= 0 else end
        data = np.frombuffer(words, dtype=np.uint8, count=end - at, offset=at)
        gaps = np.flatnonzero(data == 32)
        start = np.concatenate(([0], gaps + 1))
        stop = np.concatenate((gaps, [len(data)]))
        found.append(between(prefix(BYTE[data]), start, stop))
        at = end + 1
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
