"""Memory manners of Python workers.

Spark keeps idle Python workers beside the executor's JVM for the next task. What a task
freed is given back to the system when it ends, so that idle workers cost little.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not the GNU C library: nothing to trim
        pass


def tidy(run: Callable) -> Callable:
    """A mapInArrow function that gives freed memory back at its end."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped
