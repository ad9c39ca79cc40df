"""Tensor files: eight bytes of header length, a JSON header, raw little-endian buffers."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def encode(arrays: dict[str, np.ndarray]) -> bytes:
    header, at, parts = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a, "<i8").tobytes()
        header[name] = {"dtype": "I64", "shape": list(a.shape), "data_offsets": [at, at + len(raw)]}
        at += len(raw)
        parts.append(raw)
    text = json.dumps(header, separators=(",", ":")).encode()
    text += b" " * (-len(text) % 8)
    return struct.pack("<Q", len(text)) + text + b"".join(parts)


def decode(data: bytes) -> dict[str, np.ndarray]:
    (n,) = struct.unpack("<Q", data[:8])
    header = json.loads(data[8 : 8 + n])
    body = memoryview(data)[8 + n :]
    return {k: np.frombuffer(body[v["data_offsets"][0] : v["data_offsets"][1]], "<i8").reshape(v["shape"]) for k, v in header.items() if k != "__metadata__"}


def unbundled(bundles: DataFrame, rows_per_bundle: int = 4096) -> DataFrame:
    """(split, row, input_ids, attention_mask, labels) of tensor files (split, bundle, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split, bundle, content in zip(batch.column("split").to_pylist(), batch.column("bundle").to_pylist(), batch.column("content"), strict=True):
                arrays = decode(content.as_buffer().to_pybytes())
                n = len(arrays["labels"])
                cols = [pa.array([split] * n, pa.string()), pa.array(np.arange(n) + bundle * rows_per_bundle)]
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(list(arrays[c]), pa.list_(pa.int64())) for c in COLUMNS)], names=["split", "row", *COLUMNS])

    return bundles.select("split", "bundle", "content").mapInArrow(run, "split string, row long, input_ids array<long>, attention_mask array<long>, labels array<long>")


COLUMNS = ("input_ids", "attention_mask", "labels")


def bundles(padded: DataFrame, rows_per_bundle: int = 4096) -> DataFrame:
    """(split, bundle, content): padded rows packed into tensor files of a bounded
    number of rows, in row order; one task builds one bundle at a time."""
    keyed = padded.withColumn("bundle", (F.col("row") / rows_per_bundle).cast("long"))
    ordered = keyed.repartition("split", "bundle").sortWithinPartitions("split", "bundle", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            arrays = {c: np.array([r[i] for r in held], np.int64).reshape(len(held), -1) for i, c in enumerate(COLUMNS)}
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([encode(arrays)], pa.binary())], names=["split", "bundle", "content"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("split", "bundle", *COLUMNS)), strict=True):
                if key is not None and row[:2] != key:
                    yield packed()
                    held = []
                key = row[:2]
                held.append(row[2:])
        if key is not None:
            yield packed()

    return ordered.select("split", "bundle", *COLUMNS).mapInArrow(run, "split string, bundle long, content binary")
