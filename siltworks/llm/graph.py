"""Distributed union-find: connected components of very many links.

Links are first contracted in chunks of ``CHUNK``, each by union-find in one
task; a chunk's components come out as stars.  A graph of one chunk is done
then.  Otherwise the stars go through alternating large-star and small-star
steps (after Kiveris et al., "Connected Components in MapReduce and Beyond")
until nothing changes.  Minima there are partial aggregates, written to the
shared folder like each round's edges; the joins with them then shuffle both
sides, so a hub with very many links can be split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import batches, scratch

#: Links that one task contracts at once, 16 bytes each.
CHUNK = 1_000_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node but the least of its component, and that least node."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    top = np.arange(len(nodes))
    while True:
        x, y = top[a], top[b]
        apart = x != y
        if not apart.any():
            return nodes[top != np.arange(len(nodes))], nodes[top[top != np.arange(len(nodes))]]
        np.minimum.at(top, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (again := top[top] != top).any():
            top[again] = top[top[again]]


def _contracted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in rows:
        held.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
        size += len(batch)
        if size >= 2 * CHUNK:  # a partition may be larger than meant; its stars stay in
            held = [stars(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            size = len(held[0][0]) if len(held[0][0]) < CHUNK else 0
            if not size:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], names=["u", "v"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in stars(*(np.concatenate(x) for x in zip(*held, strict=True)))], names=["u", "v"])


def _result(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())


def components(edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, component) for every node of an edge (a, b); the component is its smallest node."""
    e = edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = scratch.table(e, "edges")
    parts = max(1, -(-e.count() // chunk))
    e = scratch.table(batches.mapped(e.repartition(parts), _contracted, "u long, v long"), "contracted")
    if parts == 1:
        return _result(e)
    e, before = scratch.table(e.distinct(), "edges"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return _result(e)
        before = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = scratch.table(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        low = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = scratch.table(moved.union(low).distinct(), "small-star")
