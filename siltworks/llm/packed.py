"""Rows of packed numpy arrays, dealt to shards by key.

A map task turns millions of small entries into one row per shard, so a
shuffle moves a few large rows instead of very many small ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources import scratch

#: Entries a task gathers before it hands them on.
FLUSH = 300_000
#: Bytes of input for each shard at most: a task holds one shard's entries.
SHARD_BYTES = 64 << 20


def schema(columns: dict[str, str]) -> str:
    return ", ".join(["shard int", *[f"{c} binary" for c in columns]])


def shards(df: DataFrame) -> int:
    """Shards for what comes from ``df``: the session's shuffle partitions, or more
    if the files read are large."""
    size = scratch.read_bytes(df) or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))


class Packer:
    """Gathers arrays; ``flush`` gives a batch with one row per shard that has entries."""

    def __init__(self, columns: dict[str, str], n: int):
        self.columns, self.n, self.held, self.size = columns, n, [], 0

    def add(self, shard: np.ndarray, **arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(shard):
            self.held.append((shard.astype(np.uint16 if self.n < 1 << 16 else np.int32), {c: arrays[c].astype(kind) for c, kind in self.columns.items()}))
            self.size += len(shard)
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        shard = np.concatenate([s for s, _ in self.held])
        order = np.argsort(shard, kind="stable")
        edge = np.searchsorted(shard[order], np.arange(self.n + 1))
        full = np.flatnonzero(np.diff(edge))
        out = [pa.array(full, pa.int32())]
        for c in self.columns:
            whole = np.concatenate([a.pop(c) for _, a in self.held])[order]
            out.append(pa.array([whole[edge[i] : edge[i + 1]].tobytes() for i in full], pa.binary()))
        self.held, self.size = [], 0
        yield pa.RecordBatch.from_arrays(out, names=["shard", *self.columns])


def deal(df: DataFrame, n: int) -> DataFrame:
    """One partition per shard."""
    return df.repartitionById(n, df["shard"]) if hasattr(df, "repartitionById") else df.repartition(n, "shard")


def unpack(batches: Iterator[pa.RecordBatch], columns: dict[str, str]) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each shard of a partition, whole."""
    held: dict[int, dict[str, list[np.ndarray]]] = {}
    for batch in batches:
        for i, s in enumerate(batch.column("shard").to_pylist()):
            mine = held.setdefault(s, {c: [] for c in columns})
            for c, kind in columns.items():
                mine[c].append(np.frombuffer(batch.column(c)[i].as_buffer(), kind))
    for s in sorted(held):
        yield {c: np.concatenate(v) for c, v in held.pop(s).items()} | {"shard": s}
