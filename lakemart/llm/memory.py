"""What a Python worker keeps: a bounded memory of results by key, and nothing past a task's end."""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable, Iterable

import pyarrow as pa

from lakemart.llm import arrays


class Memory:
    """Two generations of entries.  When the new one holds ``size`` entries it
    becomes the old one, and what is asked for again moves up; so frequent keys
    stay and at most about twice ``size`` entries are held."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def clear(self) -> None:
        """Forget all entries: a task's end, as Spark keeps the worker for others."""
        self.new, self.old = {}, {}

    def missing(self, keys: Iterable) -> list:
        """Keys that must be worked out; all others are in ``new`` afterwards."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    out.append(k)
        return out


def give_back() -> None:
    """Hand freed memory back to the system.  Spark keeps a worker for later tasks
    and stages; what its allocators keep would add up beside the JVM's memory."""
    arrays.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def light(run: Callable) -> Callable:
    """``run``, a function for mapInArrow (a generator) or applyInArrow, that gives
    memory back at its end."""
    if inspect.isgeneratorfunction(run):
        @functools.wraps(run)
        def mapped(batches):
            try:
                yield from run(batches)
            finally:
                give_back()
        return mapped

    if len(inspect.signature(run).parameters) == 2:
        @functools.wraps(run)
        def joined(left: pa.Table, right: pa.Table) -> pa.Table:
            try:
                return run(left, right)
            finally:
                give_back()
        return joined

    @functools.wraps(run)
    def grouped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()
    return grouped
