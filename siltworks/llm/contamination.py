"""Benchmark decontamination by one Aho-Corasick automaton.

Method: each benchmark item's words form windows of ``window`` consecutive
words (an item of fewer has one window).  All windows stand in one automaton
over word numbers, built once on the driver: a node is a word, not a letter.
It reads every document once, and matches are mapped back to code-point offsets
of the original text.  Words are told by 64-bit hash; stretches that hold a
word of no item cannot match and are not read.

The driver and each task hold one automaton of ``MOST`` windows at most.  A
larger benchmark makes several; each reads the documents in a pass of its own
and reports the few texts it finds something in, and these reports join the
documents by the texts' SHA-256.

Null, empty and wordless texts have no words and no hits.  Items without an id
or without words have no windows.  Items with equal windows all count, and
items that share an id are one.  Equal rows get equal results; an empty table
of either kind gives no hits.  Added columns take the place of input columns
with their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import batches, textvec as tv

#: Windows in one automaton, some 500 bytes each.
MOST = 400_000
#: Bytes outside words, once A-Z are lowered.
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False

_SPAN = [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
HITS = T.ArrayType(T.StructType(_SPAN))
#: Runs of hit words: the first, the one after the last, and their code points.
RUNS = "array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>"
_RUN = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, texts, hashes) of words."""
    low = tv.LOWER[raw]
    starts, ends, owner = tv.words(low, off, BREAKS)
    return starts, ends, owner, tv.span_hash(low, starts, ends)


class Windows:
    """An automaton over the numbers of its items' words; picklable."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        raw = np.frombuffer(b"".join(t for _, t in items), np.uint8)
        _, _, owner, h = _words(raw, np.r_[0, np.cumsum([len(t) for _, t in items])].astype(np.int64))
        self.keys = np.unique(h)
        number = (np.searchsorted(self.keys, h) + 1).tolist()
        edge = tv.runs(owner, len(items)).tolist()
        found: dict[tuple[int, ...], tuple[int, set[str]]] = {}
        for (name, _), a, b in zip(items, edge[:-1], edge[1:], strict=True):
            n = min(size, b - a)
            for i in range(a, b - n + 1 if n else a):
                found.setdefault(tuple(number[i : i + n]), (n, set()))[1].add(name)
        self.shortest = min((n for n, _ in found.values()), default=0)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, (n, names) in found.items():
            self.machine.add_word(window, (n, sorted(names)))
        if found:
            self.machine.make_automaton()

    def read(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[list[dict]], list[list[str]]]:
        """(words, runs of hit words, items) of each text."""
        starts, ends, owner, h = _words(raw, off)
        n = len(off) - 1
        words = np.bincount(owner, minlength=n)
        runs: list[list[dict]] = [[] for _ in range(n)]
        items: list[set[str]] = [set() for _ in range(n)]
        if self.shortest and len(h):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            known = np.flatnonzero(self.keys[at] == h)
            cut = np.flatnonzero(np.r_[True, (np.diff(known) != 1) | (owner[known[1:]] != owner[known[:-1]])]) if len(known) else known
            size = np.diff(np.r_[cut, len(known)])
            edge = np.zeros(len(h) + 1, np.int64)
            for a, m in zip(known[cut][size >= self.shortest].tolist(), size[size >= self.shortest].tolist(), strict=True):
                for end, (k, names) in self.machine.iter(tuple((at[a : a + m] + 1).tolist())):
                    edge[a + end + 1 - k] += 1
                    edge[a + end + 1] -= 1
                    items[owner[a]].update(names)
            hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            if len(hit):
                new = np.r_[True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]])]
                first, last = hit[new], hit[np.r_[new[1:], True]]
                point = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
                base = tv.runs(owner, n)
                for a, b in zip(first.tolist(), last.tolist(), strict=True):
                    d = int(owner[a])
                    zero = point[off[d]]
                    runs[d].append({"first": a - int(base[d]), "last": b + 1 - int(base[d]), "start": int(point[starts[a]] - zero), "end": int(point[ends[b]] - zero)})
        return words, runs, [sorted(x) for x in items]


def _merged(runs: list[dict]) -> list[dict]:
    """Runs of several automata as one's."""
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["first"], r["last"])):
        if out and r["first"] <= out[-1]["last"]:
            if r["last"] > out[-1]["last"]:
                out[-1] |= {"last": r["last"], "end": r["end"]}
        else:
            out.append(dict(r))
    return out


def _parts(benchmark: DataFrame, item: str, text: str, size: int) -> Iterator[Windows]:
    """Automata of at most MOST windows, or of one item; the benchmark is read row by row."""
    held: list[tuple[str, bytes]] = []
    windows = 0
    for row in benchmark.selectExpr(f"cast(`{item}` as string) i", f"cast(`{text}` as binary) t").toLocalIterator():
        if row.i is None or not row.t:
            continue
        own = bytes(row.t)
        n = len(own) // 2 + 1  # a window needs a word and a break
        if held and windows + n > 4 * MOST:  # words have some eight bytes
            yield Windows(held, size)
            held, windows = [], 0
        held.append((row.i, own))
        windows += n
    if held:
        yield Windows(held, size)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (sorted as strings) and ``hits``.

    ``hits`` are the contaminated code-point ranges of the original text, end
    exclusive, each from its first to its last hit word.
    """
    parts = [batches.shared(docs, w) for w in _parts(benchmark, item, item_text, window)] or [batches.shared(docs, Windows([], window))]
    more = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hits", HITS)]
    schema, keep = batches.extended(docs, more)

    def told(batch: pa.RecordBatch, words: np.ndarray, runs: list[list[dict]], items: list[list[str]]) -> pa.RecordBatch:
        hits = [[{"start": r["start"], "end": r["end"]} for r in own] for own in runs]
        cols = {"n_words": pa.array(words, pa.int64()), "n_hit": pa.array([sum(r["last"] - r["first"] for r in own) for own in runs], pa.int64())}
        cols["items"] = pa.array(items, pa.list_(pa.string()))
        cols["hits"] = pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return batches.with_columns(batch, keep, cols)

    if len(parts) == 1:

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in rows:
                raw, off = tv.buffers(whole.column(text))
                for i, j in tv.blocks(off):
                    yield told(whole.slice(i, j - i), *parts[0].value.read(raw[off[i] : off[j]], off[i : j + 1] - off[i]))

        return batches.mapped(docs, run, schema)

    def report(part) -> DataFrame:
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in rows:
                raw, off = tv.buffers(whole.column("text"))
                for i, j in tv.blocks(off):
                    _, runs, items = part.value.read(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                    some = [k for k, own in enumerate(runs) if own]
                    mark = whole.column("mark").slice(i, j - i).take(pa.array(some, pa.int64()))
                    yield pa.RecordBatch.from_arrays([mark, pa.array([runs[k] for k in some], _RUN), pa.array([items[k] for k in some], pa.list_(pa.string()))], names=["mark", "runs", "found"])

        return batches.mapped(docs.select(F.sha2(F.col(text), 256).alias("mark"), F.col(text).alias("text")), run, f"mark string, runs {RUNS}, found array<string>")

    reports = report(parts[0])
    for part in parts[1:]:
        reports = reports.unionByName(report(part))
    every = reports.groupBy(F.col("mark").alias("_mark")).agg(F.flatten(F.collect_set("runs")).alias("_runs"), F.flatten(F.collect_set("found")).alias("_found"))
    joined = docs.join(every, F.sha2(F.col(text), 256) == F.col("_mark"), "left").drop("_mark")

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            raw, off = tv.buffers(whole.column(text))
            for i, j in tv.blocks(off):
                batch = whole.slice(i, j - i)
                words = np.bincount(_words(raw[off[i] : off[j]], off[i : j + 1] - off[i])[2], minlength=j - i)
                runs = [_merged(r or []) for r in batch.column("_runs").to_pylist()]
                yield told(batch, words, runs, [sorted(set(x or [])) for x in batch.column("_found").to_pylist()])

    return batches.mapped(joined, finish, schema)
