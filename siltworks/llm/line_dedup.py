"""Fuzzy line deduplication by MinHash over character shingles.

Method: a line's set of ``K``-character shingles has a signature of
``BANDS * ROWS`` minima.  Lines that agree in a band are candidates; their
exact Jaccard similarity decides (``T`` hundredths or more).  Verified pairs go
through a distributed union-find, and each component keeps its first line, by
(doc_id, line number).  A pair of similarity 0.8 agrees in some band with
probability 1 - (1 - 0.8**ROWS)**BANDS, over 0.998.

Lines are parts between line feeds; those without a word never go.  Equal
lines are one node, told by a 64-bit hash, so copies cost one row each.
Within a band's group every line is compared with the least one and with its
neighbour first, in the trees of ``prefix_tree``.  A group that very many lines
share is split over shards by line; there each line is compared first with one of
its task, and these with one another.  Groups whose lines are then
still in several components are compared in full across these, in cells of
bounded size: pairs that lengths and parity bitmaps (see ``cells``) allow are
verified, at first the nearest of a line, then all that are left.  So every
pair that shares a band is decided.

Null and empty texts have no lines.  Rows with the same id and text count as
one document and keep the same lines.  Rows without an id keep all their
lines, and these count for no other row.  Ties: of equal first places there is
none, as (id, line number) is one line.  Columns of any name are carried
along by ``dedup``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import batches as arrow, bitmap, cells, graph, jaccard, packed, scratch, textvec as tv

K, T, BANDS, ROWS = 8, 80, 12, 4
COLUMNS = {"key": "<u4", "line": "<i8"}
#: The same of hot keys: the whole key, and the line that stands for the task's lines of it.
SPREAD = {"key": "<u8", "line": "<i8", "anchor": "<i8"}
#: Lines of a block from which on their common key is hot.
HOT = 64
#: Partners of a line in the first full comparison of a block.
NEAREST = 4
#: Largest group in which the least line and the neighbours are all pairs.
WHOLE = 3
#: Line hashes that a task remembers, so that it signs an equal line once.
SEEN = 1 << 18
_A = (tv.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ROLL = 0x9E3779B97F4A7C55
assert K & (K - 1) == 0  # shingles are hashed by doubling


def _places(flags: np.ndarray) -> np.ndarray:
    """Where few of very many flags are set."""
    eights = np.zeros(-(-len(flags) // 8) * 8, bool)
    eights[: len(flags)] = flags
    some = np.flatnonzero(eights.view(np.uint64))
    row, column = np.nonzero(eights.reshape(-1, 8)[some])
    return some[row] * 8 + column


def _line_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, none empty, by sums of their mixed 8-byte words."""
    lens = ends - starts
    count = (lens + 7) >> 3
    first = np.cumsum(count) - count
    nth = np.arange(int(count.sum())) - np.repeat(first, count)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))[np.repeat(starts, count) + 8 * nth]
    words[first + count - 1] &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * (8 * count - lens)).astype(np.uint64)
    words += nth.astype(np.uint64) * np.uint64(_ROLL)
    sums = np.add.reduceat(tv.mix(words), first)
    return tv.mix(sums + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 32-bit finaliser, in place."""
    buffer = np.empty_like(x)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        np.right_shift(x, np.uint32(shift), out=buffer)
        x ^= buffer
        if factor > 1:
            x *= np.uint32(factor)
    return x


class Lines:
    """The worded lines of a block of texts, by their places in its bytes."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, feeds = data, _places(data == 10)
        starts, ends = np.sort(np.r_[off[:-1], feeds + 1]), np.sort(np.r_[feeds, off[1:]])
        some = ends > starts
        starts, ends = starts[some], ends[some]
        # a line without a word has white space only
        white = np.flatnonzero(tv.SPACE[data[starts]])
        if len(white):
            lens = ends[white] - starts[white]
            words = ~tv.SPACE[data[tv.gather(starts[white], lens)]]
            worded = np.ones(len(starts), bool)
            worded[white] = np.logical_or.reduceat(words, np.cumsum(lens) - lens)
            starts, ends = starts[worded], ends[worded]
        self.starts, self.ends = starts, ends
        self.owner = np.searchsorted(off, starts, "right") - 1
        self.number = np.searchsorted(feeds, starts) - np.searchsorted(feeds, off)[self.owner]
        self.ids = _line_hash(data, starts, ends) if len(starts) else np.zeros(0, np.int64)

    def points(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The block's code points, and the lines' starts and ends in these."""
        try:
            points = np.frombuffer(self.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:  # not UTF-8: bytes stand for themselves
            return self.data.astype(np.uint32), self.starts, self.ends
        if len(points) == len(self.data):
            return points, self.starts, self.ends
        more = _places((self.data & 0xC0) == 0x80)
        return points, self.starts - np.searchsorted(more, self.starts), self.ends - np.searchsorted(more, self.ends)

    def texts(self, which: np.ndarray) -> list[str]:
        """Some lines as strings."""
        raw = self.data.tobytes()
        cut = [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]
        try:
            return [x.decode() for x in cut]
        except UnicodeDecodeError:
            return [x.decode("latin-1") for x in cut]

    def shingles(self, which: np.ndarray, kind: type = np.uint32) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``kind`` of the shingles of some lines, and their bounds; a shorter line is one shingle."""
        points, starts, ends = self.points()
        starts, ends = starts[which], ends[which]
        n, step, roll = len(points), 1, points.astype(kind)
        while step < K and step < n:  # windows of 1, 2, 4 and 8; what is behind the last whole window is not used
            left = roll[:-step] * kind(pow(_ROLL, step, 1 << 64) & np.iinfo(kind).max)
            left += roll[step:]
            roll[:-step], step = left, 2 * step
        size = ends - starts - K + 1
        short = size < 1
        lens = np.maximum(size, 1)
        edge = np.zeros(n + 1, np.int8)
        edge[starts] = 1
        edge[starts + lens] -= 1
        h = roll[np.cumsum(edge[:n], dtype=np.int8).view(bool)]
        h = _mixed(h) if kind is np.uint32 else tv.mix(h)
        bounds = np.r_[0, np.cumsum(lens)]
        h[bounds[:-1][short]] = self.ids[which][short].astype(kind)
        return h, bounds


def _blocks(batch: pa.RecordBatch, text: str, most: int = 500_000) -> Iterator[tuple[int, int, Lines]]:
    raw, off = tv.buffers(batch.column(text))
    for i, j in tv.blocks(off, most):
        yield i, j, Lines(raw[off[i] : off[j]], off[i : j + 1] - off[i])


def char_sets(batch: pa.RecordBatch, text: str, _k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Distinct sorted shingle hashes of whole texts that are single lines; 44 bits of a hash count."""
    for i, j, lines in _blocks(batch, text):
        h, bounds = lines.shingles(np.arange(len(lines.ids)), np.uint64)
        yield i, j, *tv.distinct(h >> np.uint64(20), np.repeat(lines.owner, np.diff(bounds)), j - i, 44)


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of BANDS * ROWS hash functions over each set, a column per line."""
    out = np.empty((BANDS * ROWS, len(bounds) - 1), np.uint32)
    buffer = np.empty_like(h)
    for p in range(BANDS * ROWS):
        np.multiply(h, _A[p], out=buffer)
        np.minimum.reduceat(buffer, bounds[:-1], out=out[p])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, a column per line."""
    keys = np.empty((BANDS, signature.shape[1]), np.uint64)
    for b in range(BANDS):
        key = np.full(signature.shape[1], b + 1, np.uint64)
        for r in range(ROWS):
            key = tv.mix(key * np.uint64(0x9FB21C651E98DF25) + signature[b * ROWS + r])
        keys[b] = key
    return keys


class _Fresh:
    """Lines of a task that it has not met yet, as far as it remembers: one for each slot."""

    def __init__(self):
        self.slots = np.zeros(SEEN, np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        new = np.flatnonzero(self.slots[ids & (SEEN - 1)] != ids)
        values, first = np.unique(ids[new], return_index=True)
        self.slots[values & (SEEN - 1)] = values
        return np.sort(new[first])


class _Hot:
    """Band keys that very many lines of a task share, each with its anchor, the least line when it was found."""

    def __init__(self, least: int):
        self.least, self.keys, self.anchors = least, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, key: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which entries have a hot key, their anchors, entries that tell of keys found now: the least lines of each)."""
        slot = (key >> np.uint64(40)).astype(np.int64) & 0xFFFF
        told = np.zeros(0, np.int64)
        many = np.flatnonzero(np.bincount(slot, minlength=1 << 16)[slot] >= self.least)
        if len(many):
            many = many[np.lexsort((line[many], key[many]))]
            first = np.flatnonzero(np.r_[True, key[many][1:] != key[many][:-1]])
            count = np.diff(np.r_[first, len(many)])
            new = (count >= self.least) & ~np.isin(key[many][first], self.keys)
            if new.any():
                told = many[tv.gather(first[new], np.minimum(count[new], WHOLE + 1))]
                keys = np.r_[self.keys, key[many][first[new]]]
                order = np.argsort(keys)
                self.keys, self.anchors = keys[order], np.r_[self.anchors, line[many][first[new]]][order]
        if not len(self.keys):
            none = np.zeros(0, np.int64)
            return none, none, told
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hot = np.flatnonzero(self.keys[at] == key)
        return hot, self.anchors[at[hot]], told


def _bands(docs: DataFrame, n: int, text: str, hot: int) -> DataFrame:
    """Entries (key, line) by shard of the key; those of hot keys by shard of key and line, after the others.

    A key that ``hot`` lines of a block share is told to its own shard by a few lines of each task, and all
    other lines go to shards from ``n`` on, dealt by line, with the task's anchor to be compared with.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, spread, fresh, found = packed.Packer(COLUMNS, n), packed.Packer(SPREAD, n), _Fresh(), _Hot(hot)
        for batch in batches:
            for _, _, lines in _blocks(batch, text):
                which = fresh(lines.ids)
                if not len(which):
                    continue
                key, line = band_keys(signatures(*lines.shingles(which))).ravel(), np.tile(lines.ids[which], BANDS)
                far, anchor, told = found.find(key, line)
                if len(far):
                    stay = np.ones(len(key), bool)
                    stay[far] = False
                    stay[told] = True
                    shard = (tv.mix(key[far] ^ line[far].view(np.uint64)) % np.uint64(n)).astype(np.int64)
                    yield from (_rows(b, n) for b in spread.add(shard, key=key[far], line=line[far], anchor=anchor))
                    key, line = key[stay], line[stay]
                yield from (_rows(b, 0) for b in packer.add((key % np.uint64(n)).astype(np.int64), key=key >> np.uint64(32), line=line))
        yield from (_rows(b, 0) for b in packer.flush())
        yield from (_rows(b, n) for b in spread.flush())

    return arrow.mapped(docs.select(text), run, packed.schema(SPREAD))


def _rows(batch: pa.RecordBatch, first: int) -> pa.RecordBatch:
    """A packer's rows with shards from ``first`` on, and the column that only spread ones have."""
    shard = pa.array(batch.column("shard").to_numpy() + np.int32(first), pa.int32())
    anchor = batch.column("anchor") if "anchor" in batch.schema.names else pa.nulls(len(batch), pa.binary())
    return pa.RecordBatch.from_arrays([shard, batch.column("key"), batch.column("line"), anchor], names=["shard", "key", "line", "anchor"])


def _met(key: np.ndarray) -> np.ndarray:
    """The entries whose key others have too; most have one of their own."""
    found = np.sort(key.astype(np.uint64) << np.uint64(32) | np.arange(len(key), dtype=np.uint64))
    same = (found[1:] >> np.uint64(32)) == (found[:-1] >> np.uint64(32))
    return (found[np.r_[False, same][: len(key)] | np.r_[same, False][: len(key)]] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _proposed(a: np.ndarray, b: np.ndarray, key: np.ndarray, line: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = ["a", "b", "key", "node"]
    apart = a != b
    low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
    order = np.argsort(tv.mix(low.view(np.uint64)) ^ high.view(np.uint64))
    low, high = low[order], high[order]
    new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])][: len(low)]
    none = pa.nulls(int(new.sum()), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(low[new]), pa.array(high[new]), none, none], names=names)
    none = pa.nulls(len(key), pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, pa.array(key), pa.array(line)], names=names)


def _candidates(dealt: DataFrame, n: int) -> DataFrame:
    """Rows (a, b) for proposed pairs and (key, node) for groups that these do not cover.

    Shards up to ``n`` have whole groups, but of hot keys only the lines that tell of them; these
    are enough for the group to be listed.  The others have parts of hot groups, of any size, a row at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def plain() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("shard").to_numpy() < n
                for i in np.flatnonzero(~own).tolist():
                    key, line, anchor = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in SPREAD.items())
                    whole = (key >> np.uint64(32)).astype(np.int64) + ((key % np.uint64(n)).astype(np.int64) << 32)
                    parts.extend(_proposed(anchor, line, whole, line))
                    if sum(map(len, parts)) > packed.FLUSH:
                        yield None
                yield batch.filter(pa.array(own))

        parts: list[pa.RecordBatch] = []
        held: list[pa.RecordBatch] = []
        for batch in plain():
            yield from parts
            parts.clear()
            if batch is not None and len(batch):
                held.append(batch)
        for shard in packed.unpack(iter(held), COLUMNS):
            at = _met(shard["key"])
            at = at[np.lexsort((shard["line"][at], shard["key"][at]))]
            key, line = shard["key"][at], shard["line"][at]
            if len(key) > 1:
                new = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
                key, line = key[new], line[new]
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.r_[start, len(key)])
            first = np.repeat(start, count)
            at = np.arange(len(key))
            star, chain = at[at > first], at[at > first + 1]
            more = np.repeat(count, count) > WHOLE
            yield from _proposed(np.r_[line[first[star]], line[chain - 1]], np.r_[line[star], line[chain]], key[more].astype(np.int64) + (shard["shard"] << 32), line[more])

    return arrow.mapped(dealt, run, "a long, b long, key long, node long")


def _texts(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, text) of at least the lines that are the column ``node`` of ``nodes``, each once."""
    shared = arrow.shared(docs, bitmap.build(nodes, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = _Fresh()
        for batch in batches:
            for _, _, found in _blocks(batch, text):
                which = np.flatnonzero(bitmap.passes(shared.value, found.ids))
                which = which[fresh(found.ids[which])]
                yield pa.RecordBatch.from_arrays([pa.array(found.ids[which]), pa.array(found.texts(which), pa.string())], names=["node", "text"])

    # the join drops lines that only share their last bits with wanted ones
    rows = arrow.mapped(docs.select(text), run, "node long, text string").join(nodes.select("node"), "node", "left_semi")
    return scratch.table(rows.groupBy("node").agg(F.first("text").alias("text")), "line-texts")


def _described(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, n, bits) of some lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, h, bounds in char_sets(batch, "text", K):
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array(np.diff(bounds), pa.int64()), cells.parities(h, bounds)], names=["node", "n", "bits"])

    return scratch.table(arrow.mapped(texts.join(nodes.select("node").distinct(), "node"), run, "node long, n long, bits array<long>"), "line-bitmaps")


def occurrences(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, number, line) of every worded line; numbers count from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(doc).cast(pa.int64())
            for i, _, lines in _blocks(batch, text):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(i + lines.owner)), pa.array(lines.number, pa.int64()), pa.array(lines.ids)], names=["doc", "number", "line"])

    return arrow.mapped(docs.select(doc, text), run, "doc long, number long, line long")


def components(docs: DataFrame, text: str = "text", hot: int = HOT) -> DataFrame:
    """(node, component) of lines that have near copies."""
    n = packed.shards(docs)
    found = scratch.table(_candidates(packed.deal(_bands(docs, n, text, hot), 2 * n), n), "line-candidates")
    pairs = scratch.table(found.where("a is not null").select("a", "b").distinct(), "line-pairs")
    met = scratch.table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "line-met")
    texts = _texts(docs, text, met)
    tried = scratch.table(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "line-tried")
    links = scratch.table(jaccard.verify(tried, texts, K, T, char_sets), "line-links")
    comps = scratch.table(graph.components(links), "line-components")
    # of a hot key's group a line can be listed more than once, which only makes its blocks smaller
    groups = cells.spanning(found.where("key is not null").select("key", "node"), comps, "line")
    described = _described(groups, texts)
    for most in (NEAREST, None):
        # pairs that are left, at first; what is verified already is not verified again
        near = cells.across(groups, described, T, n, most)
        if most is not None:
            near = near.union(jaccard.apart(pairs, comps))
        found = scratch.table(near.distinct().join(tried, ["a", "b"], "left_anti"), "line-across")
        more = found.where("a is not null")
        if not more.isEmpty():
            links = scratch.table(links.union(jaccard.verify(more, texts, K, T, char_sets)), "line-links")
            comps = scratch.table(graph.components(links), "line-components")
        if found.where("a is null").isEmpty():
            break
        if most is not None:
            tried = scratch.table(tried.union(more.select("a", "b")), "line-tried")
            groups = cells.spanning(groups, comps, "line")
    return comps


@scratch.tidied
def decisions(docs: DataFrame, text: str = "text", doc: str = "doc_id", hot: int = HOT) -> DataFrame:
    """(doc, n_lines, dropped): worded lines of each document that has some, and
    the (number, line) of those that go, in order."""
    docs = docs.where(F.col(doc).isNotNull())
    comps = scratch.table(components(docs, text, hot), "line-components")
    every = occurrences(docs, text, doc)
    if not docs.groupBy(doc).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        every = every.distinct()  # repeated rows
    known = every.join(comps, every["line"] == comps["node"], "left").select("doc", "number", "line", F.coalesce("component", "line").alias("comp"))
    known = scratch.table(known, "line-occurrences")
    # a written table, so that the join below shuffles both sides and can be split where it is skewed
    first = known.groupBy("comp").agg(F.min(F.struct("doc", "number")).alias("first"), F.count("*").alias("m")).where("m > 1")
    gone = known.join(scratch.table(first.select("comp", "first"), "line-first"), "comp").where(F.struct("doc", "number") != F.col("first"))
    lost = gone.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("number", "line"))).alias("dropped"))
    none = F.expr("cast(array() as array<struct<number:bigint,line:bigint>>)")
    return known.groupBy("doc").agg(F.count("*").alias("n_lines")).join(lost, "doc", "left").select("doc", "n_lines", F.coalesce("dropped", none).alias("dropped"))


def dedup(docs: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """The documents without the dropped lines; a document that had worded lines
    and lost them all goes as well."""
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])  # so that no name clashes
    at = {c.lower(): f"_c{i}" for i, c in enumerate(docs.columns)}
    mine, own, names = at[text.lower()], at[doc.lower()], plain.columns
    found = decisions(docs.select(doc, text), text, doc).where(F.size("dropped") > 0).select(F.col("doc").alias("_doc"), F.col("dropped").alias("_dropped"))
    joined = plain.join(found, F.col(own).cast("long") == F.col("_doc"), "left").drop("_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in arrow.slices(whole, mine)):
            texts = batch.column(mine).to_pylist()
            stay = np.ones(len(texts), bool)
            touched = np.flatnonzero(batch.column("_dropped").is_valid().to_numpy(zero_copy_only=False)).tolist()
            for i in touched:
                raw = np.frombuffer((texts[i] or "").encode(), np.uint8)
                lines = Lines(raw, np.array([0, len(raw)]))
                drop = {(d["number"], d["line"]) for d in batch.column("_dropped")[i].as_py()}
                gone = {n for n, v in zip(lines.number.tolist(), lines.ids.tolist(), strict=True) if (n, v) in drop}
                if gone:
                    stay[i] = len(gone) < len(lines.ids)
                    texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in gone)
            cols = [pa.array(texts, pa.string()) if c == mine else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(stay))

    return arrow.mapped(joined, run, plain.schema).toDF(*docs.columns)
