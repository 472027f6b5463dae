"""Giving memory back when a task ends: Python workers are kept for the tasks that follow, of any stage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import wraps

import pyarrow as pa


def release() -> None:
    """Return what Arrow's pool and the C library hold for later use, where they can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not this C library
        pass


def tidy(run: Callable) -> Callable:
    """A function over batches that gives memory back once the last one is through."""

    @wraps(run)
    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped
