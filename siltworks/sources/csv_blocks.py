"""Quoted CSV in blocks: one file is read by as many tasks as it has blocks.

A block can start inside a quoted field, so where its records lie depends on all
bytes before it.  At the start of a line there are only two states, though, at a
record's start or inside quotes, and a block is a function from the state before
it to the state after.  The first pass gives each block's function and its number of
records for either state, a row per block; composed in file order they say in
which state each block starts and with which record.  The second pass parses every
block from its known state.  What a record has in further blocks travels as
fragments, which meet by the block in which the record starts.

Records, quotes and row numbers are those of the ``csv`` module's default dialect
over the whole file: a quote counts at a field's start only, carriage returns end
records as line feeds do, empty lines are no rows.  Undecodable bytes are an error
of their row, and so are records over ``LIMIT``.  Several files are numbered on in
the order of their paths, each under its own header.  A byte order mark is dropped.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows, a row of some 100 bytes for each block, that the driver puts in order.
MOST_BLOCKS = 1_000_000
#: Bytes of whole blocks inside one record; a longer one is an error of its row.
LIMIT = 1 << 30
#: Lines and bytes that are parsed at once.
LINES, BYTES = 5_000, 4 << 20
TOO_LONG = "field larger than field limit"

# From a record's start: its fields up to a bare carriage return, the end, or a quote that stays open.
_RECORD = re.compile(rb'(?:"(?:[^"]|"")*+"[^,\r]*+|[^",\r][^,\r]*+|)(?:,(?:"(?:[^"]|"")*+"[^,\r]*+|[^",\r][^,\r]*+|))*+')
# From inside quotes: the rest of the field, if it ends.
_REST = re.compile(rb'(?:[^"]|"")*+("[^,\r]*+)?')
_PARSED = "n long, raw string, error string"
_OUT = f"{_PARSED}, file long, chain long, start long, part binary"


def scan(line: bytes, quoted: bool) -> tuple[bool, int]:
    """(whether the line ends inside quotes, records that start in it)."""
    at, starts, fresh = 0, 0, not quoted
    if quoted:
        m = _REST.match(line)
        if m[1] is None:
            return True, 0
        at = m.end()
        if at == len(line):
            return False, 0
        fresh = line[at] == 13
        at += 1
    while True:
        end = _RECORD.match(line, at).end()
        opened = end < len(line) and line[end] == 34
        starts += fresh and (end > at or opened)
        if opened:
            return True, starts
        if end == len(line):
            return False, starts
        at, fresh = end + 1, True


def after(line: bytes, quoted: bool) -> tuple[bool, int]:
    """``scan``, without a look at each byte where there is no quote and no bare carriage return."""
    if b'"' not in line and line.find(b"\r", 0, -1) < 0:
        return quoted, int(not quoted and line not in (b"", b"\r"))
    return scan(line, quoted)


def rows(text: str) -> Iterator[list[str]]:
    csv.field_size_limit((1 << 31) - 1)
    return csv.reader(io.StringIO(text, newline=""))


def _lines(spark: SparkSession, uri: str) -> DataFrame:
    """(line, file, start): a file's lines within a block are in order."""
    lines = spark.read.option("lineSep", "\n").text(uri)
    return lines.select(F.col("value").cast("binary").alias("line"), F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Iterator[bytes]]]:
    """(file, start, lines) of each block of a partition; blocks come one after the other."""

    def each() -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("line").to_pylist(), strict=True)

    source = each()
    ahead = next(source, None)
    while ahead is not None:
        file, start = ahead[:2]

        def own() -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[:2] == (file, start):
                yield ahead[2]
                ahead = next(source, None)

        lines = own()
        yield file, start, lines
        for _ in lines:  # what was not read
            pass


_STATES = "file long, start long, bytes long, open0 boolean, open1 boolean, n0 long, n1 long, whole1 boolean, header binary"


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block: for a start outside (0) and inside quotes (1), the state after it
    and the records that start; whether a start inside stays inside at every line; the header's bytes."""
    for file, start, lines in _blocks(batches):
        state, n, size, whole, head, headed = [False, True], [0, 0], 0, True, [], False
        for line in lines:
            size += len(line) + 1
            whole = whole and state[1]
            if start == 0 and not headed:
                head.append(line)
            for s in (0, 1):
                state[s], more = after(line, state[s])
                n[s] += more
            headed = headed or not state[0]
        row = (file, start, size, *state, *n, whole, b"\n".join(head) if start == 0 and headed else None)
        names = [f.split()[0] for f in _STATES.split(", ")]
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], pa.schema([("file", pa.int64()), ("start", pa.int64()), ("bytes", pa.int64()), ("open0", pa.bool_()), ("open1", pa.bool_()), ("n0", pa.int64()), ("n1", pa.int64()), ("whole1", pa.bool_()), ("header", pa.binary())]))


@dataclass(frozen=True)
class Block:
    quoted: bool  # whether it starts inside quotes
    first: int  # the number of the first record that starts in it; 0 is a header
    chain: int  # the block in which the record that it starts inside has begun
    header: int  # which header its rows have
    offset: int  # rows of the files before
    long: bool  # whether the record that it ends inside is too long
    ended: bool  # whether a record that never closes ends with a line feed


class Unreadable(ValueError):
    pass


def composed(found: list, files: list) -> tuple[dict[tuple[int, int], Block], list[list[str]]]:
    """Where each block starts, from the blocks' functions in file order, and the headers."""
    if len(found) > MOST_BLOCKS:
        raise Unreadable(f"more than {MOST_BLOCKS} blocks: raise spark.sql.files.maxPartitionBytes")
    path, size = {f["file"]: f["path"] for f in files}, {f["file"]: f["size"] for f in files}
    per: dict[int, list] = {}
    for b in sorted(found, key=lambda b: (path[b["file"]], b["start"])):
        per.setdefault(b["file"], []).append(b)
    out: dict[tuple[int, int], Block] = {}
    headers: list[list[str]] = []
    offset = 0
    for file, blocks in per.items():
        if blocks[0]["header"] is None:
            raise Unreadable(f"the header of {path[file]} does not end in its block")
        try:
            headers.append(next(rows(blocks[0]["header"].decode("utf-8") + "\n"), []))
        except UnicodeDecodeError as e:
            raise Unreadable(f"cannot read {path[file]}: {e}") from e
        quoted, first, chain = False, 0 if headers[-1] else 1, blocks[0]["start"]
        inside: dict[int, int] = {}  # bytes of the whole blocks inside a record, by the block in which it starts
        starts = []
        for b in blocks:
            starts.append((b, quoted, first, chain))
            if quoted and b["whole1"]:
                inside[chain] = inside.get(chain, 0) + b["bytes"]
            else:
                chain = b["start"]
            first += b["n1"] if quoted else b["n0"]
            quoted = b["open1"] if quoted else b["open0"]
        ended = size[file] - sum(b["bytes"] for b in blocks) in (0, 3)  # 3: a byte order mark
        for b, q, n, c in starts:
            begun = c if q and b["whole1"] else b["start"]
            out[file, b["start"]] = Block(q, n, c, len(headers) - 1, offset, inside.get(begun, 0) > LIMIT, ended)
        offset += first - 1
    return out, headers


def _records(text: bytes, header: list[str], n: int, offset: int) -> Iterator[tuple[int, str | None, str | None]]:
    """(n, raw, error) of the records of a text that starts with record ``n``; 0 is the header."""
    try:
        found, broken = rows(text.decode("utf-8")), False
    except UnicodeDecodeError:
        found, broken = rows(text.decode("utf-8", "surrogateescape")), True
    try:
        for row in found:
            if not row:
                continue
            if n:
                error = None
                if broken:
                    try:
                        ",".join(row).encode("utf-8", "surrogateescape").decode("utf-8")
                    except UnicodeDecodeError as e:
                        error = str(e)
                if error is None and len(row) > len(header):
                    error = "more fields than the header"
                whole = dict(zip(header, row, strict=False)) | dict.fromkeys(header[len(row) :])
                yield n + offset, json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False) if error is None else None, error
            n += 1
    except csv.Error as e:
        yield n + offset, None, str(e)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [("n", pa.int64()), ("raw", pa.string()), ("error", pa.string()), ("file", pa.int64()), ("chain", pa.int64()), ("start", pa.int64()), ("part", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(kinds)], names=[k for k, _ in kinds])


def parsed(spark: SparkSession, uri: str) -> DataFrame:
    """(n, raw, error): the rows of the CSV files at ``uri``."""
    lines = _lines(spark, uri)
    listed = spark.read.format("binaryFile").load(uri).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    blocks, headers = composed(lines.mapInArrow(_states, _STATES).collect(), listed.collect())  # a row per block, and per file
    known = spark.sparkContext.broadcast((blocks, headers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, heads = known.value
        for file, start, own in _blocks(batches):
            b: Block = places[file, start]
            quoted, n, size = b.quoted, b.first, 0
            head: list[bytes] | None = [] if quoted else None  # of a record that began earlier
            ready: list[bytes] = []
            open_: list[bytes] = []  # lines since the last one that started outside quotes
            starts = held = 0  # records that start in ``open_`` and in ``ready``

            def done() -> pa.RecordBatch:
                return _batch([(*r, None, None, None, None) for r in _records(b"\n".join([*ready, b""]), heads[b.header], n, b.offset)])

            for line in own:
                if not quoted:
                    if head is not None:
                        if not places[file, b.chain].long:
                            yield _batch([(None, None, None, file, b.chain, start, b"\n".join([*head, b""]))])
                        head = None
                    ready += open_
                    held, open_, starts = held + starts, [], 0
                    if len(ready) >= LINES or size >= BYTES:
                        yield done()
                        n, ready, held, size = n + held, [], 0, 0
                (open_ if head is None else head).append(line)
                size += len(line)
                quoted, more = after(line, quoted)
                starts += more if head is None else 0
                n += more if head is not None else 0
            if not quoted and head is None:
                ready += open_
                open_ = []
            if ready:
                yield done()
            if head is not None:
                if not places[file, b.chain].long:
                    yield _batch([(None, None, None, file, b.chain, start, b"\n".join([*head, b""]))])
            elif quoted:
                if b.long:
                    yield _batch([(n + held + b.offset, None, TOO_LONG, None, None, None, None)])
                else:
                    yield _batch([(n + held, None, None, file, start, start, b"\n".join([*open_, b""]))])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, heads = known.value
        for batch in batches:
            for file, chain, n, parts, never in zip(*(batch.column(c).to_pylist() for c in ("file", "chain", "n", "parts", "never")), strict=True):
                b: Block = places[file, chain]
                text = b"".join(p["part"] for p in parts)
                if never and not b.ended:
                    text = text[:-1]
                found = list(_records(text, heads[b.header], n, b.offset))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.string()), pa.array([r[2] for r in found], pa.string())], names=["n", "raw", "error"])

    last: dict[int, int] = {}
    for file, start in blocks:
        last[file] = max(last.get(file, 0), start)
    ends = spark.createDataFrame([*last.items()] or [(0, 0)], "file long, last long")
    out = lines.mapInArrow(run, _OUT)
    parts = out.where("part is not null").groupBy("file", "chain").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
    # a record that reaches the last block may never close; a line feed at the end does not matter to one that does
    chains = parts.join(F.broadcast(ends), "file").select("file", "chain", "n", "parts", (F.get("parts", F.size("parts") - 1)["start"] == F.col("last")).alias("never"))
    return out.where("part is null").select("n", "raw", "error").unionByName(chains.mapInArrow(joined, _PARSED))
