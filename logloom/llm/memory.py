"""Bounded memory of Python workers: Arrow batches and slices of them, memos with a bound in bytes, one tool per worker."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial
from itertools import islice
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes of text of a slice; a longer text is a slice by itself.
SLICE_BYTES = 4 << 20
# Spark's bound on the bytes of a batch besides that on its rows.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# What the worker holds between tasks: one tool, by its key.
_HELD: dict[tuple, Any] = {}


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``most`` bytes of ``column`` at most."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def tool(make: Callable, *how: Any) -> Any:
    """``make(*how)``, kept for later tasks of this worker until another tool is asked for.

    Workers are used again by later stages; what an earlier stage remembered goes then.
    """
    key = (make.__module__, make.__qualname__, *how)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make(*how)
    return _HELD[key]


@contextmanager
def small_batches(spark: SparkSession, most: int = SLICE_BYTES) -> Iterator[None]:
    """Jobs that run meanwhile hand workers batches of about ``most`` bytes, not of 10 000 rows however long.

    A session with a bound of its own keeps it.
    """
    if spark.conf.get(BATCH_BYTES, None) is not None:
        yield
        return
    spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES)


def give_back() -> None:
    """What is free goes back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _lean(batches: Iterator[pa.RecordBatch], step: Callable) -> Iterator[pa.RecordBatch]:
    _HELD.clear()
    try:
        yield from step(batches)
    finally:
        give_back()


def lean(step: Callable) -> Callable:
    """``step`` over batches, for tasks without a tool: what the worker holds for an earlier stage goes before, free memory after them."""
    return partial(_lean, step=step)


@contextmanager
def at_work(make: Callable, *how: Any) -> Iterator[Any]:
    """``tool`` for the time of a task; after it, its memos keep little.

    An executor has more workers than tasks at a time, and what the idle ones hold counts as well.
    """
    found = tool(make, *how)
    try:
        yield found
    finally:
        for value in vars(found).values():
            if isinstance(value, Memo):
                value.rest()
        give_back()


class Memo:
    """Names and what they give, in two generations of half of ``most`` bytes each.

    When the young generation is full it becomes the old one, and what has not been asked for since
    then goes at the next turn. Turns only happen in ``settle``, so all that ``missing`` found is at hand until then.
    """

    # Bytes of Python objects that an entry needs besides its name and value, about.
    ENTRY = 150
    # So many names stay over a rest.
    RESTING = 150_000

    def __init__(self, most: int):
        self.most, self.used = most // 2, 0
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, names: set) -> set:
        """The names that are not known; all others are young afterwards."""
        names = names.difference(self.young)
        if self.old and names:
            back = names.intersection(self.old)
            self.young.update(zip(back, map(self.old.__getitem__, back)))
            self.used += len(back) * (self.ENTRY + 32)
            names -= back
        return names

    def put_all(self, names: list, values: list) -> None:
        """Names and values that have a length, bytes for instance."""
        self.young.update(zip(names, values))
        self.used += self.ENTRY * len(names) + 2 * sum(map(len, names)) + sum(map(len, values))

    def put(self, name: Any, value: Any, size: int = 0) -> None:
        self.young[name] = value
        self.used += self.ENTRY + 2 * len(name) + size

    def drop(self, name: Any, size: int = 0) -> None:
        del self.young[name]
        self.used -= self.ENTRY + 2 * len(name) + size

    def settle(self) -> None:
        if self.used > self.most:
            self.old, self.young, self.used = self.young, {}, 0

    def rest(self) -> None:
        """Keep only names that were asked for in both generations, and not many."""
        both = self.young.keys() & self.old.keys() if self.old else self.young.keys()
        self.old, self.young, self.used = {x: self.young[x] for x in islice(both, self.RESTING)}, {}, 0
