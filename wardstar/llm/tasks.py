"""Giving memory back at the end of a task, for workers that serve many stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import cache, wraps

import pyarrow as pa


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that returns freed memory to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Return what was freed; cheap enough for the end of each batch or group."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def give_back() -> None:
    gc.collect()
    release()


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which the worker holds no more than before."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole
