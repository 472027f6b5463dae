"""Functions from a list of texts to a float32 matrix, called once per batch inside a task."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence

import numpy as np

EmbedFn = Callable[[Sequence[str]], np.ndarray]


class HashingEmbedder:
    """Signed feature hashing of white-space tokens: needs no model and is the same everywhere.

    The first eight hex digits of a token's MD5 choose the dimension, the ninth the sign.
    """

    #: Tokens whose slot is remembered at a time.
    CACHED = 1 << 18

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._slots: dict[str, int] = {}

    def __getstate__(self):
        return {"dim": self.dim, "_slots": {}}

    def _slot(self, token: str) -> int:
        digest = hashlib.md5(token.encode()).hexdigest()
        dimension = int(digest[:8], 16) % self.dim
        slot = dimension if int(digest[8], 16) % 2 == 0 else dimension + self.dim
        if len(self._slots) >= self.CACHED:
            self._slots.clear()
        self._slots[token] = slot
        return slot

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype="float32")
        known = self._slots
        for row, text in enumerate(texts):
            slots = [known[t] if t in known else self._slot(t) for t in text.split()]
            signed = np.bincount(np.array(slots, dtype="int64"), minlength=2 * self.dim)
            out[row] = signed[: self.dim] - signed[self.dim :]
        return out


class Retrying:
    """Call ``fn`` again after a failure, waiting ``min(60, 2^n)`` seconds before try ``n``."""

    def __init__(self, fn: EmbedFn, retries: int = 5, sleep: Callable[[float], None] = time.sleep):
        self.fn, self.retries, self.sleep = fn, retries, sleep

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        for attempt in range(1, self.retries + 2):
            try:
                return self.fn(texts)
            except Exception:
                if attempt > self.retries:
                    raise
                self.sleep(min(60.0, 2.0**attempt))
        raise AssertionError("unreachable")
