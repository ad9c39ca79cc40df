"""Phrases whose words occur together more often than their parts suggest.

Method: texts are cut into pieces at punctuation and line ends, and identical
pieces become one row with a multiplicity, so copied text is counted once.  N-grams
are counted length by length, weighted by multiplicity: a task gathers them,
sums equal ones, and packs the rest into one row per hash bucket; each bucket
is counted in duckdb, by the words themselves, within ``MEMORY`` and beyond
that out of core.  Counts under ``least`` are not kept.  An n-gram can
reach ``least`` only if both of its (n-1)-grams do, so the tasks of the next length
leave out what a bitmap of those (8 MB, of one size whatever the corpus) does not
hold; what it lets through by chance is counted and dropped like the rest.
A candidate's parts then come to it by requests: each cut asks for its two
parts' counts, and requests and counts are shuffled by part to meet.

Out-of-core files lie in Spark's own local folders, like those of its sorts; they
belong to one task, which deletes them.

Null languages count as ``und``; null and empty texts have no pieces.  Pieces
without a word are none.  Equal rows count as often as they occur.  Ties rank by
count, then phrase.  Other columns of any name are left out.  A text without
any punctuation is one piece, whatever its length.  An empty table gives an
empty result.
"""

from __future__ import annotations

import os
import shutil
import string
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import batches, bitmap, packed, scratch, textvec as tv

#: N-grams and bytes of text that a task gathers before it hands them on.
FLUSH, FLUSH_BYTES = 300_000, 16 << 20
#: Memory of duckdb for a bucket; beyond, it goes out of core.
MEMORY = "192MB"
#: Parts of each language that are ranked alone before they meet.
PARTS = 64
_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True
_ENTRY = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("w", pa.int64())])


def pieces(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, piece, w): the distinct pieces, words joined by one space, and how often each occurs."""
    lowered = F.translate(F.col(text), string.ascii_uppercase, string.ascii_lowercase)
    cut = F.split(F.regexp_replace(lowered, r"[\x20\x09]+", " "), r"[.,;:!?\x0A-\x0D]")
    each = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.explode(cut).alias("piece"))
    return each.select("lang", F.trim("piece").alias("piece")).where("piece != ''").groupBy("lang", "piece").agg(F.count("*").alias("w"))


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return tv.mix(tv.span_hash(data, starts, ends) ^ lang)


def _lang_hash(column: pa.Array) -> np.ndarray:
    data, off = tv.buffers(column)
    return tv.span_hash(data, off[:-1], off[1:]) * np.uint64(0xD6E8FEB86659FD93)


class Gathered:
    """N-grams of a task until they are handed on, as spans of the blocks that they come from."""

    def __init__(self, n: int):
        self.n, self.langs = n, {}
        self.clear()

    def clear(self) -> None:
        self.data, self.held, self.size, self.bytes = [], [], 0, 0

    def add(self, data: np.ndarray, lang: pa.Array, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray, w: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key):
            for x in lang.unique().to_pylist():
                self.langs.setdefault(x, len(self.langs))
            code = np.array([self.langs[x] for x in lang.to_pylist()], np.int32)
            self.held.append((key, starts + self.bytes, ends - starts, code[owner], w[owner]))
            self.data.append(data)
            self.size, self.bytes = self.size + len(key), self.bytes + len(data)
        if self.size >= FLUSH or self.bytes >= FLUSH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """A batch with a row per bucket: the bucket's n-grams of this task, equal ones summed."""
        if not self.size:
            return
        data = np.concatenate(self.data)
        key, at, size, lang, w = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.clear()
        order = np.argsort(key)
        key, at, size, lang, w = key[order], at[order], size[order], lang[order], w[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (size[1:] != size[:-1]) | (lang[1:] != lang[:-1])
        again = np.flatnonzero(~new)
        if len(again):  # the same key is the same n-gram only if the bytes agree
            differ = data[tv.gather(at[again], size[again])] != data[tv.gather(at[again - 1], size[again])]
            new[again] = np.add.reduceat(differ, np.cumsum(size[again]) - size[again]) > 0
        first = np.flatnonzero(new)
        total = np.add.reduceat(w, first)
        key, at, size, lang = key[first], at[first], size[first], lang[first]
        bound = np.r_[0, np.cumsum(size)].astype(np.int32)
        body = data[tv.gather(at, size)]
        phrase = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bound), pa.py_buffer(body)])
        names = pa.array(list(self.langs), pa.string()).take(pa.array(lang))
        whole = pa.RecordBatch.from_arrays([names, phrase, pa.array(total, pa.int64())], schema=_ENTRY)
        edge = np.searchsorted(bucket(key, self.n), np.arange(self.n + 1))  # keys in order have their buckets in order
        full = np.flatnonzero(np.diff(edge))
        blobs = [whole.slice(edge[i], edge[i + 1] - edge[i]).serialize().to_pybytes() for i in full]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "blob"])


def bucket(key: np.ndarray, n: int) -> np.ndarray:
    """Buckets in the order of keys, by their leading half; the bitmap looks at the last bits."""
    return (((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def grams(df: DataFrame, m: int, shorter: np.ndarray | None, n: int) -> DataFrame:
    """(shard, blob): the m-grams of pieces, packed by bucket; those that hold an
    (m-1)-gram outside the bitmap ``shorter`` stay out."""
    known = None if shorter is None else batches.shared(df, shorter)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered(n)
        for whole in parts:
            for batch in batches.slices(whole, "piece"):
                lang = batch.column("lang")
                raw, off = tv.buffers(batch.column("piece"))
                data, off = raw[off[0] : off[-1]], off - off[0]
                seed = _lang_hash(lang)
                starts, ends, owner = tv.words(data, off, _SPACE)
                if len(starts) < m:
                    continue
                i = np.flatnonzero(owner[m - 1 :] == owner[: len(owner) - m + 1])
                if known is not None:
                    j = np.flatnonzero(owner[m - 2 :] == owner[: len(owner) - m + 2])
                    often = np.zeros(len(owner) + 1, bool)
                    often[j] = bitmap.passes(known.value, _keys(data, starts[j], ends[j + m - 2], seed[owner[j]]).view(np.int64))
                    i = i[often[i] & often[i + 1]]
                begin, end, of = starts[i], ends[i + m - 1], owner[i]
                w = batch.column("w").to_numpy(zero_copy_only=False)
                yield from held.add(data, lang, of, begin, end, w, _keys(data, begin, end, seed[of]))
        yield from held.flush()

    return batches.mapped(df, run, "shard int, blob binary")


def counted(dealt: DataFrame, m: int, least: int) -> DataFrame:
    """(lang, phrase, m, f, key): the n-grams of each bucket that occur ``least`` times, counted in duckdb."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = (pa.ipc.read_record_batch(blob.as_buffer(), _ENTRY) for batch in parts for blob in batch.column("blob"))
        head = next(entries, None)
        if head is None:
            return
        spill = tempfile.mkdtemp(prefix="phrases-", dir=os.environ["SPARK_LOCAL_DIRS"].split(",")[0])
        con = duckdb.connect(config={"memory_limit": MEMORY, "threads": 1, "temp_directory": spill, "preserve_insertion_order": False})
        try:
            con.register("entry", pa.RecordBatchReader.from_batches(_ENTRY, (x for y in ([head], entries) for x in y)))
            found = con.sql(f"SELECT lang, phrase, CAST(sum(w) AS BIGINT) AS f FROM entry GROUP BY lang, phrase HAVING sum(w) >= {int(least)}")
            for batch in found.to_arrow_reader(50_000):
                data, off = tv.buffers(batch.column("phrase"))
                key = _keys(data, off[:-1], off[1:], _lang_hash(batch.column("lang")))
                out = {"m": pa.repeat(pa.scalar(m, pa.int32()), len(batch)), "f": batch.column("f"), "key": pa.array(key.view(np.int64))}
                yield batches.with_columns(batch, ["lang", "phrase"], out)
        finally:
            con.close()
            shutil.rmtree(spill, ignore_errors=True)

    found = batches.mapped(dealt, run, "lang string, phrase binary, m int, f long, key long")
    return found.withColumn("phrase", F.col("phrase").cast("string"))


def counts(df: DataFrame, longest: int, least: int, n: int) -> DataFrame:
    """(lang, phrase, m, f): all phrases of 1 to ``longest`` words that occur ``least`` times."""
    levels: list[DataFrame] = []
    shorter = None
    for m in range(1, longest + 1):
        levels.append(scratch.table(counted(packed.deal(grams(df, m, shorter, n), n), m, least), f"phrase-counts-{m}"))
        if m < longest:
            shorter = bitmap.build(levels[-1], "key")
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.drop("key")


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): each candidate with its lowest-scoring cut."""
    cuts = found.where("m > 1").select("lang", "phrase", "m", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    first, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - m)")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("left"), first.alias("part")), F.struct(F.lit(False).alias("left"), rest.alias("part"))))
    requests = scratch.table(cuts.select("lang", "phrase", "a", "k", sides.alias("x")).select("lang", "phrase", "a", "k", "x.left", "x.part"), "phrase-requests")
    known = found.select("lang", F.col("phrase").alias("part"), "f")
    met = requests.join(known, ["lang", "part"]).select("lang", "phrase", "a", "k", "left", "f")
    both = met.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    both = both.withColumns({"top": _exact("a") * F.lit(2_000_000), "under": _exact("l") + _exact("r")}).withColumn("score", F.expr("top div under"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def contained(found: DataFrame) -> DataFrame:
    """(lang, phrase, longer): of candidates inside longer ones, the largest count of one."""
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda i: F.concat_ws(" ", F.slice(w, i, size)))))
    each = found.where("m > 2").select("lang", "f", F.explode(inner).alias("phrase"))
    return each.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


@scratch.tidied
def mine(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, most: int = 2000, inside: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut that scores least,
    ``n`` the language's words; the score is floor(2,000,000 a / (l + r)), exact.  A phrase
    inside a longer candidate with at least ``inside`` hundredths of its count is left out.
    """
    n = packed.shards(docs)
    known = scratch.table(pieces(docs, text, lang), "phrase-pieces")
    words = F.length("piece") - F.length(F.translate("piece", " ", "")) + 1
    totals = known.groupBy("lang").agg(F.sum(F.col("w") * words).alias("n"))
    found = counts(known, longest, least, n)
    kept = scored(found).join(contained(found), ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _exact("longer") < inside * _exact("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each part first, so that no task ranks a whole language
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
