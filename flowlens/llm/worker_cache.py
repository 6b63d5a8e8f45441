"""What a Python worker keeps between batches: one thing at a time.

Spark uses a worker for one stage after another. A model or a memory of words that an earlier stage has left there would
add to what the next one needs, so asking for another thing, or for none, lets the last one go.

Between its tasks a worker waits beside an executor that may need all of its own memory for joins and sorts. What a task has
freed goes back to the system, as the allocators would keep it for the next task of this worker."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Hashable, Iterator
from functools import cache, wraps
from typing import Any, TypeVar

import pyarrow as pa

T = TypeVar("T")
_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], T]) -> T:
    if key not in _kept:
        clear()
        _kept[key] = make()
    return _kept[key]


def clear() -> None:
    if _kept:
        _kept.clear()
    pa.default_memory_pool().release_unused()


@cache
def _trim() -> Callable[[int], object]:
    """What the C library has for this; one without it keeps its memory."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: None)


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(work: Callable[[Any], Iterator[T]]) -> Callable[[Any], Iterator[T]]:
    """``work`` on the batches of a task, giving back free memory after every batch that it yields and at its end."""
    @wraps(work)
    def done(batches: Any) -> Iterator[T]:
        for out in work(batches):
            yield out
            del out
            give_back()
        gc.collect()
        give_back()

    return done


def tidy_group(work: Callable[..., T]) -> Callable[..., T]:
    """``work`` on a group of rows or a column, giving back free memory after it."""
    @wraps(work)
    def done(*given: Any) -> T:
        out = work(*given)
        give_back()
        return out

    done.__signature__ = inspect.signature(work)  # Spark looks for the number of arguments
    return done
