"""Shared by the operators: reading tables, walking Arrow batches in slices of bounded size, intermediates, prefix sums.

Python code runs inside ``mapInArrow`` only. A batch that Spark hands over may hold long texts, so every operator works it
off in slices of at most ``SLICE_BYTES`` of text (one longer text is a slice of its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderloom.session import scratch_path

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: done once, and not lost with an executor."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array and the offsets of its rows in it; null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Freed memory goes back to the system: Arrow and the C library keep it otherwise, and Spark keeps a worker for the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the C library that has it
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, lean: bool = False) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices of at most ``limit`` bytes of one column. ``lean``: memory is given back after each slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer_of(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
            if lean:
                give_back()


def string_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Rows ``data[offsets[i]:offsets[i + 1]]`` without a copy of the bytes."""
    return pa.Array.from_buffers(kind or pa.string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """ASCII white space splits. Codes of all words in order, the distinct words they stand for, word offsets of the rows."""
    import pyarrow.compute as pc
    lists = pc.ascii_split_whitespace(texts)
    values = lists.values if not lists.offset else lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    full = pc.not_equal(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    if not full.all():      # white space at either end of a text leaves empty words
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        values = values.filter(pa.array(full))
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, bounds


def with_base(df: DataFrame, part: str, size: str, base: str) -> DataFrame:
    """Adds the sum of ``size`` over all parts before a row's part. One row per part of a written table takes part in the
    running sum, whatever the number of rows."""
    totals = df.groupBy(part).agg(F.sum(size).alias("_total"))
    before = Window.orderBy(F.col(part).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col(part), F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias(base))
    return df.join(F.broadcast(bases), part)      # bounded: a few bytes per task that wrote a part
