"""Vectorised text primitives on Arrow string buffers.

Words, lines and shingles are hashed for whole batches at once: no Python
object is made per word.  A word hash is a polynomial over its bytes taken
from prefix sums modulo 2**64, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULT = np.uint64(0x9E3779B97F4A7C55)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
#: Bytes of text handled at once, unless a single text is longer.
BLOCK = 500_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, BLOCK + 1024)
        up, down = np.full(n, _MULT), np.full(n, _INV)
        up[0] = down[0] = 1
        _powers = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    y = x >> np.uint64(30)
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    z = y >> np.uint64(27)
    y ^= z
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hashes of the byte spans [starts, ends) of ``data``."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(seed)
    terms *= up[: len(data)]
    np.cumsum(terms, out=sums[1:])
    body = (sums[ends] - sums[starts]) * down[starts]
    return mix(body + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def blocks(off: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together; a longer one stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text index) of the maximal runs without break bytes.

    ``off`` holds the texts' bounds in ``data``; a run never crosses one.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~breaks[data]
    bound = np.zeros(len(data) + 1, bool)
    bound[off] = True
    cur, prev = inside[1:], inside[:-1]
    starts = np.flatnonzero(cur & (~prev | bound))
    ends = np.flatnonzero(prev & (~cur | bound))
    owner = np.searchsorted(off, starts, "right") - 1
    return starts, ends, owner


def runs(owner: np.ndarray, n: int) -> np.ndarray:
    """Bounds (n + 1 long) of each owner's rows in sorted ``owner``."""
    return np.searchsorted(owner, np.arange(n + 1))


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + len)."""
    total = int(lens.sum())
    shift = np.cumsum(lens) - lens
    return np.repeat(starts - shift, lens) + np.arange(total)


def distinct(h: np.ndarray, owner: np.ndarray, n: int, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each owner, sorted, and their bounds.

    Values of ``bits`` bits are sorted together with their owners where both fit
    64; others go by as many of their leading bits as fit, then in full.
    """
    room = 64 - max(1, int(n - 1).bit_length())
    if bits <= room:
        key = np.sort(owner.astype(np.uint64) << np.uint64(bits) | h)
        if len(key):
            key = key[np.r_[True, key[1:] != key[:-1]]]
        owner, h = (key >> np.uint64(bits)).astype(np.int64), key & np.uint64((1 << bits) - 1)
        return h, runs(owner, n)
    order = np.argsort(owner.astype(np.uint64) << np.uint64(room) | (h >> np.uint64(bits - room)))
    h, owner = h[order], owner[order]
    if len(h) > 1:
        # the few that agree in the leading bits only may be out of order
        tied = np.flatnonzero((h[1:] < h[:-1]) & (owner[1:] == owner[:-1]))
        if len(tied):
            order = np.lexsort((h, owner))
            h, owner = h[order], owner[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]
        h, owner = h[new], owner[new]
    return h, runs(owner, n)


def shingles(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes, sorted within each text, and their bounds.

    A text with some words, but fewer than k, has its whole sequence as one.
    """
    n = len(bounds) - 1
    counts = np.diff(bounds)
    acc = mix(h + np.uint64(k))
    whole = acc.copy()
    step = np.uint64(0x9FB21C651E98DF25)
    for i in range(1, k):
        more = acc[: len(h) - i] * step
        more += h[i:]
        acc[: len(h) - i] = mix(more)
    owner = np.repeat(np.arange(n), counts)
    place = np.arange(len(h)) - np.repeat(bounds[:-1], counts)
    full = place + k <= counts[owner]
    out_h, out_o = acc[full], owner[full]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        vals = whole[bounds[short]]
        left = counts[short].astype(np.int64)
        for i in range(1, k):
            more = left > i
            vals[more] = mix(vals[more] * step + h[bounds[short][more] + i])
        vals = mix(vals ^ left.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        out_h, out_o = np.concatenate([out_h, vals]), np.concatenate([out_o, short])
    return distinct(out_h, out_o, n)
