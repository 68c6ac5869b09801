"""Memory of the Python workers, which outlive their tasks and serve all operators.

What one operator keeps in a worker for its next task, and freed memory that the
allocators hold back, would add to what the tasks of others need.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Hashable, Iterator
from types import ModuleType
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")


def _kept() -> dict[Hashable, object]:
    return sys.modules.setdefault("_tradeflow_kept", ModuleType("_tradeflow_kept")).__dict__.setdefault("kept", {})


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """One object for all tasks of a worker that ask for it, until a task asks for
    another one or is of an operator that keeps nothing."""
    found = _kept()
    if key not in found:
        found.clear()
        found[key] = make()
    return found[key]


def _give_back() -> None:
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False):
    """``run`` as a task that drops what others keep in its worker, unless it ``keeps``
    something itself, and at its end gives free memory back to the system."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _kept().clear()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task
