"""Quality by perplexity under an interpolated modified Kneser-Ney model.

Method: trusted documents (good and not toxic by their labels) give bigram
counts.  Symbols are the ``WORDS`` most frequent tokens and the 256 bytes: any
other token is spelled by its bytes, so nothing is cut off and every text is
scored in full.  Counts lie sharded by bigram; documents send their distinct
bigrams to the shards, which join them with the counts and send back one
partial sum per document and shard.  Statistics of single symbols have a bound
and go to every task; so do the ``HOT`` most frequent bigrams, which frees the
shards of keys that many documents share.

A trusted document is scored without its own counts, so that its score is like
that of a document outside the training set.  Scores are mean negative log
probabilities of tokens, drawn towards their language's mean by ``SHRINK``
tokens, as short texts scatter, in whole thousandths.  A document is kept when
its score is at most its language's limit: the ``Q`` hundredths quantile of
trusted documents' scores plus ``SLACK`` times the distance from their median to
it.  Quantiles are exact, from counts of scores.  Languages with fewer than
``LEAST`` trusted documents take the limit over all.

Sums are whole thousandths of a nat, so nothing depends on task order.  Null
texts count as empty.  Documents without tokens have no perplexity; they, and
all documents when nothing is trusted, are kept.  Rows with the same id are one
document with one row in the result, under the least of their languages; rows
without an id are not scored, and kept.  Equal texts have equal perplexities
unless one is trusted.  Ties at the limit are kept.  Other columns of any name
are left out.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import batches as arrow, packed, scratch, textvec as tv

#: Tokens that are symbols of their own.  Ids fit 16 bits: 0 for a text's start,
#: then the bytes, from FIRST on the tokens.  What lies beyond is spelled, not lost.
WORDS = 65_000
FIRST = 257
#: Bigrams sent to every task, 12 bytes each.
HOT = 100_000
#: Trusted ids that are broadcast at most (some 30 MB); beyond, documents join them by shuffle.
BROADCAST_IDS = 500_000
#: Languages whose means and limits are broadcast at most.
BROADCAST_LANGS = 10_000
Q, SLACK, SHRINK, LEAST = 99, 0.25, 20, 50
#: Bigrams and documents that a task gathers before it hands them on.
FLUSH, FLUSH_DOCS = 1_000_000, 60_000
#: Texts numbered at once; numbers fit 16 bits.
ROWS = 5_000
SCALE = 1000

_CLASS = np.where(tv.SPACE, 0, 2)
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS = _CLASS.astype(np.int8)
ROW = "shard int, kind int, uid long, a binary, b binary, c binary"
MODEL, EVENT, TABLE = 0, 1, 2


@dataclass
class Tokens:
    """Tokens of some texts: runs of letters and digits, or of other signs, with a first capital folded."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray  # each token's text
    h: np.ndarray


def tokens(data: np.ndarray, off: np.ndarray) -> Tokens:
    if not len(data):
        none = np.zeros(0, np.int64)
        return Tokens(data, none, none, none, np.zeros(0, np.uint64))
    kind = _CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[off] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    folded = data.copy()
    folded[starts] = tv.LOWER[data[starts]]
    return Tokens(folded, starts, ends, np.searchsorted(off, starts, "right") - 1, tv.span_hash(folded, starts, ends))


def _blocks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, Tokens]]:
    raw, off = tv.buffers(batch.column(text))
    for first, last in tv.blocks(off):
        for i in range(first, last, ROWS):
            j = min(last, i + ROWS)
            yield i, j, tokens(raw[off[i] : off[j]], off[i : j + 1] - off[i])


@dataclass
class Vocabulary:
    """Token hashes in order and their ids; ``total``: how many tokens there are."""

    keys: np.ndarray
    ids: np.ndarray
    total: int

    def symbols(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(ids, texts) of the symbols: a token's own id, or those of its bytes."""
        ids = np.zeros(len(t.h), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, t.h), len(self.keys) - 1)
            ids = np.where(self.keys[at] == t.h, self.ids[at], 0)
        many = np.where(ids > 0, 1, t.ends - t.starts)
        spelled = 1 + t.data[tv.gather(t.starts, many)].astype(np.int64)
        own = np.repeat(ids, many)
        return np.where(own > 0, own, spelled), np.repeat(t.owner, many)

    def bigrams(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(keys, texts) of each symbol with the one before."""
        ids, owner = self.symbols(t)
        before = np.zeros(len(ids), np.int64)
        before[1:] = np.where(owner[1:] == owner[:-1], ids[:-1], 0)
        return (before << 16 | ids).astype(np.uint32), owner


def flagged(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, text, trusted)."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("_id")).distinct().withColumn("_t", F.lit(True))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    slim = docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    return slim.join(good, F.col("doc") == F.col("_id"), "left").select("doc", "text", F.coalesce("_t", F.lit(False)).alias("trusted"))


def vocabulary(trusted: DataFrame) -> Vocabulary:
    """The most frequent tokens of all trusted texts; at most WORDS reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c, pa.int64())], names=["h", "c"])

        for batch in batches:
            for _, _, t in _blocks(batch, "text"):
                held.append(t.h)
                size += len(t.h)
                if size >= FLUSH:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = scratch.table(arrow.mapped(trusted, run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "kn-words")
    top = counts.orderBy(F.desc("c"), "h").limit(WORDS).toArrow()
    h = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    return Vocabulary(h[order], order + FIRST, total)


def _put(keys: np.ndarray) -> bytes:
    """Sorted keys as 16-bit steps; a step of 65535 has its key in full at the end."""
    step = np.diff(np.r_[0, keys.astype(np.int64)])
    far = step >= 65535
    return np.minimum(step, 65535).astype("<u2").tobytes() + keys[far].astype("<u4").tobytes()


def _get(raw: pa.Buffer, n: int) -> np.ndarray:
    step = np.frombuffer(raw, "<u2", n).astype(np.int64)
    full = np.frombuffer(raw, "<u4", offset=2 * n)
    far = np.flatnonzero(step == 65535)
    step[far] = 0
    run = np.cumsum(step)
    fix = np.zeros(n, np.int64)
    fix[far] = np.diff(np.r_[0, full.astype(np.int64) - run[far]])
    return (run + np.cumsum(fix)).astype(np.uint32)


def _row(shard: int, kind: int, uid: int, a: bytes, b: bytes, c: bytes) -> tuple:
    return shard, kind, uid, a, b, c


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["shard", "kind", "uid", "a", "b", "c"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def _split(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bounds, part keys): keys by shard, and within it by what is left of the key."""
    shard, part = keys % np.uint32(n), keys // np.uint32(n)
    order = np.lexsort((part, shard))
    return order, np.searchsorted(shard[order], np.arange(n + 1)), part[order]


def count_bigrams(trusted: DataFrame, words: Vocabulary, n: int) -> DataFrame:
    """Sharded counts: MODEL rows with a shard's keys (a) and counts (b)."""
    shared = arrow.shared(trusted, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def dealt() -> pa.RecordBatch:
            keys, c = np.unique(np.concatenate(held), return_counts=True)
            order, edge, part = _split(keys, n)
            c = c[order]
            return _batch([_row(s, MODEL, 0, _put(part[i:j]), c[i:j].astype("<u4").tobytes(), b"") for s, (i, j) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if j > i])

        for batch in batches:
            for _, _, t in _blocks(batch, "text"):
                keys, _ = shared.value.bigrams(t)
                held.append(keys)
                size += len(keys)
                if size >= FLUSH:
                    yield dealt()
                    held, size = [], 0
        if size:
            yield dealt()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for s, a, b in zip(batch.column("shard").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                c = np.frombuffer(b.as_buffer(), "<u4")
                held.setdefault(s, []).append((_get(a.as_buffer(), len(c)), c))
        for s in sorted(held):
            keys, at = np.unique(np.concatenate([k for k, _ in held[s]]), return_inverse=True)
            c = np.bincount(at, np.concatenate([c for _, c in held.pop(s)])).astype("<u4")
            yield _batch([_row(s, MODEL, 0, _put(keys), c.tobytes(), b"")])

    return scratch.table(arrow.mapped(packed.deal(arrow.mapped(trusted, run, ROW), n), summed, ROW), "kn-counts")


@dataclass
class Unigrams:
    """What the model needs besides bigram counts: arrays over the vocabulary."""

    discount: np.ndarray  # D1, D2, D3+ at index 1..3
    total: np.ndarray  # tokens after each context
    back: np.ndarray  # weight of the lower order after each context
    lower: np.ndarray  # the lower order's probabilities
    hot_keys: np.ndarray
    hot_counts: np.ndarray

    def log_p(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        before, after = (keys >> np.uint32(16)).astype(np.int64), (keys & np.uint32(0xFFFF)).astype(np.int64)
        seen = np.maximum(counts - self.discount[np.minimum(counts, 3)], 0)
        total = self.total[before]
        return np.log(np.where(total > 0, seen / np.maximum(total, 1), 0) + self.back[before] * self.lower[after])


def _discounts(counts_of: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts from the numbers of things seen 1, 2, 3 and 4 times."""
    n1, n2, n3, n4 = (float(max(x, 1)) for x in counts_of)
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(np.array(d), [0, 0.05, 0.1, 0.15], [0, 0.95, 1.9, 2.85])


def unigrams(counts: DataFrame, n: int, words: Vocabulary) -> Unigrams:
    """Sums over the shards, by token: a table no longer than the vocabulary; and
    the most frequent bigrams, of those that are seen as often as a 4 * HOT-th of all
    tokens, which are a few times HOT however many shards there are."""
    often = max(1, words.total // (4 * HOT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, a, b in zip(batch.column("shard").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                c = np.frombuffer(b.as_buffer(), "<u4").astype(np.int64)
                keys = _get(a.as_buffer(), len(c)) * np.uint32(n) + np.uint32(s)
                cols = [("total", keys >> np.uint32(16), c), ("cont", keys & np.uint32(0xFFFF), np.ones(len(c), np.int64))]
                cols += [(f"n{k}", (keys >> np.uint32(16))[m], c[m] * 0 + 1) for k, m in ((1, c == 1), (2, c == 2), (3, c >= 3))]
                cols += [("of", c[c <= 4], np.ones(int((c <= 4).sum()), np.int64))]
                many = c >= often
                cols += [("hot", keys[many], c[many])]
                for name, key, value in cols:
                    if name != "hot":
                        key, at = np.unique(key, return_inverse=True)
                        value = np.bincount(at, value, len(key)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(value)], names=["name", "key", "v"])

    stats = scratch.table(arrow.mapped(counts, run, "name string, key long, v long"), "kn-stats")
    sums = stats.where("name != 'hot'").groupBy("name", "key").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    size = FIRST + len(words.keys)
    at = {name: np.zeros(size, np.int64) for name in ("total", "cont", "n1", "n2", "n3", "of")}
    for name, part in sums.groupby("name"):
        at[name][part["key"].to_numpy()] = part["v"].to_numpy()
    d = _discounts(at["of"][1:5])
    total = at["total"].astype(float)
    back = np.where(total > 0, (d[1] * at["n1"] + d[2] * at["n2"] + d[3] * at["n3"]) / np.maximum(total, 1), 1.0)
    cont = at["cont"]
    low = _discounts(np.array([(cont == k).sum() for k in (1, 2, 3, 4)]))
    kept = np.maximum(cont - low[np.minimum(cont, 3)], 0)
    types = max(1, cont.sum())
    lower = kept / types + (1 - kept.sum() / types) / size
    hot = stats.where("name = 'hot'").orderBy(F.desc("v"), "key").limit(HOT).toArrow()
    keys, values = hot.column("key").to_numpy().astype(np.uint32), hot.column("v").to_numpy()
    order = np.argsort(keys)
    return Unigrams(d, total, back, lower, keys[order], values[order])


def _nats(log_p: np.ndarray, times: np.ndarray) -> np.ndarray:
    return np.rint(log_p * SCALE).astype(np.int64) * times


def events(docs: DataFrame, words: Vocabulary, model: Unigrams, n: int) -> DataFrame:
    """EVENT rows (a keys, b text numbers, c twice the count, plus 1 for trusted
    texts) and TABLE rows (a ids, b tokens, c sums known here) of each task's texts."""
    shared = arrow.shared(docs, (words, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, uni = shared.value
        base = TaskContext.get().partitionId() << 24  # the same when a task runs again
        serial = size = held_docs = 0
        held: list[tuple[np.ndarray, ...]] = []
        table: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            uid = base + serial
            ids, count, known = (np.concatenate(x) for x in zip(*table, strict=True))
            yield _batch([_row(uid % n, TABLE, uid, ids.tobytes(), count.tobytes(), known.tobytes())])
            keys, text, c = (np.concatenate(x) for x in zip(*held, strict=True))
            order, edge, part = _split(keys, n)
            text, c = text[order].astype("<u2"), c[order].astype("<u4")
            yield _batch([_row(s, EVENT, uid, _put(part[i:j]), text[i:j].tobytes(), c[i:j].tobytes()) for s, (i, j) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if j > i])

        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False).astype(np.int64)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, t in _blocks(batch, "text"):
                if held and (size + len(t.h) > FLUSH or held_docs + hi - lo > FLUSH_DOCS):
                    yield from dealt()
                    serial, size, held_docs, held, table = serial + 1, 0, 0, [], []
                keys, owner = vocab.bigrams(t)
                both, c = np.unique(owner.astype(np.uint64) << np.uint64(32) | keys, return_counts=True)
                text, key = (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)
                sums = np.zeros(hi - lo, np.int64)
                own = trusted[lo:hi][text]
                if len(uni.hot_keys):
                    at = np.minimum(np.searchsorted(uni.hot_keys, key), len(uni.hot_keys) - 1)
                    hot = uni.hot_keys[at] == key
                    p = uni.log_p(key[hot], np.maximum(uni.hot_counts[at[hot]] - own[hot] * c[hot], 0))
                    np.add.at(sums, text[hot], _nats(p, c[hot]))
                    text, key, c, own = text[~hot], key[~hot], c[~hot], own[~hot]
                held.append((key, text + held_docs, 2 * c + own))
                table.append((ids[lo:hi], np.bincount(t.owner, minlength=hi - lo).astype(np.int64), sums))
                size, held_docs = size + len(key), held_docs + hi - lo
        if held:
            yield from dealt()

    return arrow.mapped(docs.where("doc is not null"), run, ROW)


def _join(rows: DataFrame, model: Unigrams, n: int) -> DataFrame:
    """Shards join events with counts; TABLE rows pass through."""
    shared = arrow.shared(rows, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni: Unigrams = shared.value
        shard, known, values = -1, np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for batch in batches:
            for s, kind, uid, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("shard", "kind", "uid", "a", "b", "c")), strict=True):
                if s != shard:  # a shard's model comes before its events
                    shard, known, values = s, np.zeros(0, np.uint32), np.zeros(0, np.int64)
                if kind == MODEL:
                    values = np.frombuffer(b, "<u4").astype(np.int64)
                    known = _get(pa.py_buffer(a), len(values))
                    continue
                if kind == TABLE:
                    yield _batch([_row(s, TABLE, uid, a, b, c)])
                    continue
                text, times = np.frombuffer(b, "<u2").astype(np.int64), np.frombuffer(c, "<u4").astype(np.int64)
                part = _get(pa.py_buffer(a), len(text))
                count = np.zeros(len(part), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                    count = np.where(known[at] == part, values[at], 0)
                own, times = times & 1, times >> 1
                p = uni.log_p(part * np.uint32(n) + np.uint32(s), np.maximum(count - own * times, 0))
                which, at = np.unique(text, return_inverse=True)
                sums = np.zeros(len(which), np.int64)
                np.add.at(sums, at, _nats(p, times))
                yield _batch([_row(s, EVENT, uid, which.astype("<u2").tobytes(), sums.tobytes(), b"")])

    return arrow.mapped(packed.deal(rows, n).sortWithinPartitions("shard", "kind"), run, ROW)


def _assemble(parts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, list[np.ndarray]] = {}
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for kind, uid, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("kind", "uid", "a", "b", "c")), strict=True):
                if kind == TABLE:
                    tables[uid] = [np.frombuffer(x, "<i8") for x in (a, b, c)]
                else:
                    sums.setdefault(uid, []).append((np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<i8")))
        for uid, (ids, count, known) in tables.items():
            total = known.copy()
            for text, part in sums.get(uid, []):
                total[text] += part
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count), pa.array(total)], names=["doc", "n_tokens", "log_p"])

    return arrow.mapped(parts.repartition(n, "uid"), run, "doc long, n_tokens long, log_p long")


def _small(by_lang: DataFrame, name: str) -> DataFrame:
    """A table with a row per language, broadcast if it is as short as it should be."""
    table = scratch.table(by_lang, name)
    return F.broadcast(table) if table.count() <= BROADCAST_LANGS else table


@scratch.tidied
def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity, score, score_limit, kept)."""
    n = packed.shards(docs)
    slim = flagged(docs, labels, text, doc)
    trusted = slim.where("trusted").select("text")
    words = vocabulary(trusted)
    counts = count_bigrams(trusted, words, n)
    model = unigrams(counts, n, words)
    parts = _join(events(slim, words, model, n).unionByName(counts), model, n)
    sums = _assemble(parts, n).groupBy("doc").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("log_p").alias("log_p"))
    named = docs.select(F.col(doc).cast("long").alias("doc"), F.coalesce(F.col(lang), F.lit("")).alias("lang"))
    about = named.where("doc is not null").groupBy("doc").agg(F.min("lang").alias("lang"))
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc"), F.lit(True).alias("trusted")).distinct()
    scored = about.join(sums, "doc", "left").join(good, "doc", "left").withColumn("cost", -F.col("log_p"))
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("n_tokens", "long"), ("log_p", "long"), ("trusted", "boolean"), ("cost", "long"))]
    scored = scratch.table(scored.unionByName(named.where("doc is null").select("doc", "lang", *nothing)), "kn-scores")
    proven = scored.where("trusted and n_tokens > 0")
    mean = F.sum("cost") / F.sum("n_tokens")
    means = _small(proven.groupBy("lang").agg(mean.alias("mean")), "kn-means")
    everywhere = proven.agg(mean.alias("mean")).first()["mean"]
    shrunk = (F.col("cost") + SHRINK * F.coalesce("mean", F.lit(everywhere).cast("double"))) / (F.col("n_tokens") + SHRINK)
    whole = F.round(F.when(F.col("n_tokens") > 0, shrunk)).cast("long")

    def with_score(df: DataFrame) -> DataFrame:
        return df.join(means, "lang", "left").withColumn("score", whole)

    counted = scratch.table(with_score(proven).groupBy("lang", "score").agg(F.count("*").alias("n")), "kn-score-counts")

    def limit(counts: DataFrame) -> DataFrame:
        """A limit for each language, in whole thousandths; there are some 30,000 scores at most."""
        by = Window.partitionBy("lang")
        run = counts.withColumns({"upto": F.sum("n").over(by.orderBy("score")), "m": F.sum("n").over(by)})
        at = lambda share: F.min(F.when(100 * F.col("upto") >= share * F.col("m"), F.col("score")))
        found = run.groupBy("lang").agg(F.max("m").alias("m"), at(50).alias("mid"), at(Q).alias("high"))
        return found.select("lang", "m", F.floor(F.col("high") + SLACK * (F.col("high") - F.col("mid"))).alias("lim"))

    own = _small(limit(counted).where(F.col("m") >= LEAST).select("lang", F.col("lim").alias("own_limit")), "kn-limits")
    every = limit(counted.groupBy("score").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(""))).first()
    bound = F.coalesce("own_limit", F.lit(every["lim"] if every else None).cast("long"))
    out = with_score(scored).join(own, "lang", "left")
    return out.select(
        F.col("doc").alias("doc_id"), "lang", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.when(F.col("n_tokens") > 0, F.exp(F.col("cost") / SCALE / F.col("n_tokens"))).alias("perplexity"),
        (F.col("score") / SCALE).alias("score"), (bound / SCALE).alias("score_limit"), F.coalesce(F.col("score") <= bound, F.lit(True)).alias("kept"),
    )
