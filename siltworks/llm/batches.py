"""Tasks over Arrow batches, and operators that add columns to them."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, types as T

from . import textvec as tv


Batches = Iterator[pa.RecordBatch]
_shared: list[Broadcast] = []


def shared(df: DataFrame, value: Any) -> Broadcast:
    """A value for every task, noted for ``release``."""
    made = df.sparkSession.sparkContext.broadcast(value)
    _shared.append(made)
    return made


def release() -> None:
    """Drops the executors' copies of shared values; one that is used again is sent again."""
    while _shared:
        _shared.pop().unpersist()


def mapped(df: DataFrame, run: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` whose workers hand memory back at a task's end.

    Workers stay for the next tasks, so what they kept would add up over stages.
    Within a task freed memory is kept and used again, which saves page faults.
    """

    def lean(batches: Batches) -> Batches:
        try:
            libc = ctypes.CDLL(None)
            libc.mallopt(-3, 1 << 23)  # M_MMAP_THRESHOLD
            libc.mallopt(-1, 1 << 24)  # M_TRIM_THRESHOLD
        except (OSError, AttributeError):  # another C library
            libc = None
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            gc.collect(1)  # young objects only, as a full collection takes longer than many a task
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return df.mapInArrow(lean, schema)


def texts(column: pa.Array) -> list[str]:
    """A string column as Python strings; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about tv.BLOCK bytes of text each."""
    _, off = tv.buffers(batch.column(column))
    for i, j in tv.blocks(off):
        yield batch.slice(i, j - i)


def with_columns(batch: pa.RecordBatch, keep: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    cols = {c: batch.column(c) for c in keep} | more
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def extended(df: DataFrame, more: list[T.StructField]) -> tuple[T.StructType, list[str]]:
    """The schema with added fields, and the input columns that stay: added fields
    take the place of columns with their names."""
    added = {f.name.lower() for f in more}
    kept = [f for f in df.schema if f.name.lower() not in added]
    return T.StructType([*kept, *more]), [f.name for f in kept]
