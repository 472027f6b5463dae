"""Elias-Fano coding of non-decreasing numbers, with a select structure.

n numbers below u take about 2 + log2(u / n) bits each: the low bits side by side, the high bits as
a bit vector in which the i-th one stands at (high part of the i-th number) + i. The places of every
256th one are kept in 32 bits, so select looks at a few hundred bits whatever the length.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QQBI")
SAMPLE = 256


def encode(values: np.ndarray) -> bytes:
    """Code non-negative, non-decreasing 64-bit numbers; none at all is allowed."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(low)).astype(np.int64)
    ones = high + np.arange(n)
    upper = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    upper[ones] = 1
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)[:, 64 - low:] if low else np.zeros((n, 0), np.uint8)
    return (HEAD.pack(n, len(upper), low, len(ones[::SAMPLE])) + ones[::SAMPLE].astype("<u4").tobytes()
            + np.packbits(bits.ravel()).tobytes() + np.packbits(upper).tobytes())


class Reader:
    """Numbers of a code, one by one or all together."""

    def __init__(self, code: bytes):
        self.n, self.size, self.low, samples = HEAD.unpack_from(code)
        at = HEAD.size
        self.samples = np.frombuffer(code, "<u4", samples, at)
        at += 4 * samples
        self.lower = np.frombuffer(code, np.uint8, (self.n * self.low + 7) // 8, at)
        self.upper = np.frombuffer(code, np.uint8, (self.size + 7) // 8, at + len(self.lower))

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the i-th one of the upper bits."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, width = at // 8, 64
        skip = at % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.upper[byte:byte + width])[skip:])
            if left < len(ones):
                return byte * 8 + skip + int(ones[left])
            left -= len(ones)
            byte, skip, width = byte + width, 0, width * 2

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low = 0
        if self.low:
            start = i * self.low
            bits = np.unpackbits(self.lower[start // 8:(start + self.low + 7) // 8])[start % 8:start % 8 + self.low]
            low = int("".join(map(str, bits.tolist())), 2)
        return ((self.select(i) - i) << self.low) | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, count=self.size))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.zeros((self.n, 64), dtype=np.uint8)
            bits[:, 64 - self.low:] = np.unpackbits(self.lower, count=self.n * self.low).reshape(self.n, self.low)
            out |= np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
        return out
