"""Comparison of sets within groups that span several components, in cells.

A group is cut into blocks of ``BLOCK`` sets, and a cell compares two blocks
(or one with itself): so no task holds a group whole.  Only sets of different
components are compared, by their lengths and parity bitmaps, in numpy; pairs
that these allow are candidates.

A parity bitmap tells for each bit whether an odd number of a set's n-grams
fall on it.  Two bitmaps differ in no more bits than the sets have n-grams not
in common, so a similar pair always passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import batches as arrow, scratch

#: Sets of a group that are compared at once with as many others.
BLOCK = 2048


def parities(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each set's bitmap as 64-bit words: 2.5 to 5 bits for an n-gram, 2**16 at most."""
    sizes = np.diff(bounds)
    log = np.clip(np.ceil(np.log2(np.maximum(sizes, 1) * 2.5)), 6, 16).astype(np.int64)
    at = np.r_[0, np.cumsum(1 << log)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = at[owner] + (h & ((1 << log[owner]) - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=at[-1]).astype(np.uint8) & 1
    return pa.ListArray.from_arrays(pa.array(at >> 6, pa.int32()), pa.array(np.packbits(odd, bitorder="little").view("<i8")))


def differing(x: Column, y: Column) -> Column:
    """Bits in which two bitmaps differ; the larger is folded to the smaller's length.

    Sets whose lengths allow similarity have lengths at most one doubling apart.
    """

    def fold(v: Column) -> Column:
        half = (F.size(v) / 2).cast("int")
        return F.zip_with(F.slice(v, F.lit(1), half), F.slice(v, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    x, y = F.when(F.size(x) > F.size(y), fold(x)).otherwise(x), F.when(F.size(y) > F.size(x), fold(y)).otherwise(y)
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, n: s + n)


def allowed(x: Column, y: Column, nx: Column, ny: Column, t: int) -> Column:
    """Whether lengths and bitmaps allow t; true where a bitmap is missing."""
    near = 100 * F.least(nx, ny) >= t * F.greatest(nx, ny)
    enough = F.floor((nx + ny - differing(x, y)) / 2) >= F.ceil(t * (nx + ny) / F.lit(100.0 + t))
    return F.coalesce(near & enough, F.lit(True))


def plausible(pairs: DataFrame, known: DataFrame, t: int) -> DataFrame:
    """(a, b, n, apart) of the pairs whose bitmaps allow t; ``known`` has node, n and
    bits, n is b's, and ``apart`` is the least possible share of n-grams not in common."""
    side = lambda x: known.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    kept = joined.where(allowed(F.col("bitsa"), F.col("bitsb"), F.col("na"), F.col("nb"), t))
    return kept.select("a", "b", F.col("nb").alias("n"), F.coalesce(differing(F.col("bitsa"), F.col("bitsb")) / (F.col("na") + F.col("nb")), F.lit(0.0)).alias("apart"))


def spanning(groups: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """``groups`` (key, node, and more) with ``comp`` and the group's size ``m``, of
    those groups that span several components.  Of groups with the same members
    one stays."""
    more = [c for c in groups.columns if c not in ("comp", "m")]
    known = groups.select(*more).join(comps.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(*more, F.coalesce("component", "node").alias("comp"))
    known = scratch.table(known, f"{name}-groups")
    mark = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    spans = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), mark.alias("mark")).where("lo < hi")
    one = scratch.table(spans.groupBy("m", "mark").agg(F.min("key").alias("key")).select("key", "m"), f"{name}-mixed")
    return scratch.table(known.join(one, "key"), f"{name}-spanning")


def _pairs(rows: dict[str, np.ndarray], t: int, most: int | None) -> Iterator[np.ndarray]:
    """Pairs of a cell's sets (side 0 with side 1, or all with all if there is no
    side 1) that may be similar; of each set the ``most`` nearest.  An empty array
    tells that others are left out."""
    width = np.diff(rows["off"])
    two = bool(rows["side"].any())
    mine = {}
    for side in (0, 1) if two else (0,):
        for w in np.unique(width):
            at = np.flatnonzero((width == w) & (rows["side"] == side))
            if len(at):
                mine[side, int(w)] = at, rows["bits"][rows["off"][at][:, None] + np.arange(w)]
    for (side, w), (x, bx) in mine.items():
        if side:
            continue
        for v in (w // 2, w, 2 * w) if two else (w, 2 * w):
            if (int(two), v) not in mine:
                continue
            y, by = mine[int(two), v]
            u = min(v, w)
            fold = lambda b: b[:, :u] ^ b[:, u:] if b.shape[1] > u else b  # noqa: B023, E731
            cx, cy = fold(bx), fold(by)
            step = max(1, 500_000 // len(y))
            for i in range(0, len(x), step):
                p = x[i : i + step]
                apart = np.zeros((len(p), len(y)), np.int32)
                for k in range(u):
                    apart += np.bitwise_count(cx[i : i + step, k, None] ^ cy[None, :, k])
                np_, ny = rows["n"][p][:, None], rows["n"][y][None]
                ok = (rows["comp"][p][:, None] != rows["comp"][y][None]) & (100 * np.minimum(np_, ny) >= t * np.maximum(np_, ny))
                ok &= (np_ + ny - apart) // 2 >= -(-t * (np_ + ny) // (100 + t))
                if not two and v == w:
                    ok &= p[:, None] < y[None]
                if most is not None and ok.sum(1).max() > most:
                    yield np.zeros((0, 2), np.int64)
                    near = np.argpartition(np.where(ok, apart, np.iinfo(np.int32).max), most - 1, axis=1)[:, :most]
                    r, c = np.nonzero(np.take_along_axis(ok, near, 1))
                    c = near[r, c]
                else:
                    r, c = np.nonzero(ok)
                if len(r):
                    a, b = rows["node"][p[r]], rows["node"][y[c]]
                    yield np.stack([np.minimum(a, b), np.maximum(a, b)], 1)


def across(groups: DataFrame, described: DataFrame, t: int, n: int, most: int | None = None) -> DataFrame:
    """(a, b): pairs of sets of a group (key, node, comp, m) in different components
    that may be similar by ``described`` (node, n, bits); nulls if some are left out."""
    blocks = F.ceil(F.col("m") / BLOCK)
    block = F.pmod(F.xxhash64("node"), blocks)
    rows = groups.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.join(described.select("node", "n", "bits"), "node")
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("long").alias("side"), "node", "comp", "n", "bits")
    dealt = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")

    def cell(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).combine_chunks()
        rows = {c: whole.column(c).to_numpy() for c in ("side", "node", "comp", "n")}
        lists = whole.column("bits").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        rows["off"] = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        rows["bits"] = lists.flatten().to_numpy().view(np.uint64)
        for pairs in _pairs(rows, t, most):
            a, b = (pa.array(pairs[:, c]) if len(pairs) else pa.nulls(1, pa.int64()) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            at = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], 1)
            edge = np.r_[0, np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1, len(at)]
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if held and tuple(at[lo]) != last:
                    yield from cell(held)
                    held = []
                last = tuple(at[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from cell(held)

    return arrow.mapped(dealt, run, "a long, b long").distinct()
