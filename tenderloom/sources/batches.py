"""Arrow batches worked off in slices of bounded size, so a worker's memory doesn't grow with the rows or bytes of a batch."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
SLICE_ROWS = 2048


def give_back() -> None:
    """Freed memory goes back to the system; Arrow and the C library keep it otherwise, as long as Spark keeps the worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the C library that has it
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices of at most ``SLICE_BYTES`` of one column (a larger value is a slice of its own)
    and ``SLICE_ROWS`` rows. Memory is given back after each slice."""
    for batch in batches:
        first, weight = 0, 0
        for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            size = size or 0
            if i > first and (weight + size > SLICE_BYTES or i - first == SLICE_ROWS):
                yield batch.slice(first, i - first)
                give_back()
                first, weight = i, 0
            weight += size
        if first < batch.num_rows:
            yield batch.slice(first)
            give_back()
