"""Exact Jaccard join of word n-gram sets, and its connected components.

Method: sets are ordered by one global order, rare n-grams first.  Two sets
with similarity t or more share an n-gram among the first
``n - ceil(t n) + 1`` of each (prefix filter), so only those are dealt to
shards by n-gram.  Sets that meet there become candidates; a candidate's set
stands in the prefix tree of the least set it met, whose self-join finds what
is similar (see ``prefix_tree``): overlaps along shared paths are counted once,
and subtrees are left by remaining-length bounds.

Equal sets are one node, told by a 64-bit sum over their n-grams, so exact
copies cost one row each.  Before any text is fetched, a candidate pair must
pass a bound by lengths and parity bitmaps (see ``cells``).

Groups of more than ``LIGHT`` sets (near copies, shared passages) are not
paired out.  They give pairs with a leader and between neighbours, at first;
after those are joined, a few rounds compare each set outside its group's
largest component with sets inside: of one drawn per n-gram, those whose
bitmaps are nearest.  What then still spans several components is compared
across them in cells of bounded size, so no link is lost, while groups of near
copies cost about in proportion to their size.  The most frequent n-grams are
split over several shards.

The global order has two parts: n-grams by hash, after them the ``HOT`` most
frequent ones by rising frequency.  Frequencies come from all texts: a task
reports what it sees often, the reports are summed.  Any order gives the same
result; a better one only shortens the work.

N-grams are compared by 64-bit hash.  Null, empty and wordless texts have
empty sets and no links; a text of fewer words has its whole sequence as one
n-gram.  Rows with the same id count as one document: they share a component.
Rows without an id count for nothing but their own row, which has the
component of equal texts.  Ties (equal sets, equal similarities) do not
matter: the component's least id names it.  Other columns of any name are left
out.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import batches as arrow, bitmap, cells, graph, packed, prefix_tree, scratch, textvec as tv

#: Most frequent n-grams that go last in the order; 20 bytes each to every task.
HOT = 1_000_000
#: Sightings of an n-gram for each shard that it is split over.
SPLIT = 200_000
#: Largest group whose pairs are all proposed at once; n-grams in more documents count as frequent.
LIGHT = 8
#: Rounds of comparisons with the largest component, and partners of a set in each.
ROUNDS, NEAREST = 2, 4
#: N-grams that a task counts at once.
SEEN = 1_000_000
#: Candidates in one prefix tree, and n-grams of its sets, unless one set alone has more.
TREE, TREE_GRAMS = 128, 200_000
#: N-grams whose trees are joined at once.
BATCH = 200_000
COLUMNS = {"h": "<u8", "node": "<i8", "size": "<u4", "pos": "<u4"}
#: Bit of an entry's place that tells that its n-gram is split.
_SPLIT = np.uint32(1 << 31)

Sets = Callable[[pa.RecordBatch, str, int], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]


def sets(batch: pa.RecordBatch, text: str, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, n-gram hashes, bounds) of blocks of a batch; hashes rise within a text."""
    raw, off = tv.buffers(batch.column(text))
    for i, j in tv.blocks(off):
        data = tv.LOWER[raw[off[i] : off[j]]]
        at = off[i : j + 1] - off[i]
        starts, ends, owner = tv.words(data, at)
        h = tv.span_hash(data, starts, ends)
        yield i, j, *tv.shingles(h, tv.runs(owner, j - i), k)


def signature(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, equal for equal sets."""
    out = np.diff(bounds).astype(np.uint64)
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.r_[np.uint64(0), np.cumsum(tv.mix(h ^ np.uint64(seed)))]
        out = tv.mix(out + tv.mix(sums[bounds[1:]] - sums[bounds[:-1]]))
    return out.view(np.int64)


def summarise(docs: DataFrame, k: int, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """One pass: rows (doc, n, node, bits) per document and (h, c) per n-gram a task sees often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "n", "node", "bits", "h", "c"]
        seen: list[np.ndarray] = []
        held = 0

        def often() -> Iterator[pa.RecordBatch]:
            if not seen:
                return
            h, c = np.unique(np.concatenate(seen), return_counts=True)
            many = c > 1
            h, c = h[many].view(np.int64), c[many]
            none = pa.nulls(len(h), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.nulls(len(h), pa.list_(pa.int64())), pa.array(h), pa.array(c, pa.int64())], names=names)

        for batch in batches:
            ids = batch.column(doc).cast(pa.int64())
            for i, j, h, bounds in sets(batch, text, k):
                none, n = pa.nulls(j - i, pa.int64()), np.diff(bounds)
                node = pa.array(signature(h, bounds), mask=n == 0)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n, pa.int64()), node, cells.parities(h, bounds), none, none], names=names)
                seen.append(h)
                held += len(h)
                if held > SEEN:
                    yield from often()
                    seen, held = [], 0
        yield from often()

    return arrow.mapped(docs.select(doc, text), run, "doc long, n long, node long, bits array<long>, h long, c long")


def frequent(summary: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, rising by frequency, and their counts; at most ``most`` reach the driver."""
    top = summary.where("h is not null").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") > LIGHT)
    table = top.orderBy(F.desc("c"), "h").limit(most).toArrow()
    h, c = table.column("h").to_numpy(), table.column("c").to_numpy()
    order = np.lexsort((h, c))
    return h[order].view(np.uint64), c[order]


class Order:
    """The global order: rank 0 for n-grams by hash, then the frequent ones."""

    def __init__(self, hot: np.ndarray, counts: np.ndarray):
        order = np.argsort(hot)
        self.keys, self.rank, self.parts = hot[order], (order + 1).astype(np.int32), (1 + counts[order] // SPLIT).astype(np.int32)
        self.leads = np.zeros(1 << 23, bool)  # by leading bits: most n-grams are seen not to be frequent at once
        self.leads[(hot >> np.uint64(41)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, shards that the n-gram is split over)."""
        rank, parts = np.zeros(len(h), np.int32), np.ones(len(h), np.int32)
        some = np.flatnonzero(self.leads[(h >> np.uint64(41)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
            known = self.keys[at] == h[some]
            rank[some[known]], parts[some[known]] = self.rank[at[known]], self.parts[at[known]]
        return rank, parts


def _prefix(h: np.ndarray, bounds: np.ndarray, order: Order, t: int) -> tuple[np.ndarray, ...]:
    """(hash, text index, size, position, parts) of every prefix n-gram; t in hundredths."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank, parts = order.of(h)
    by = np.argsort(owner << 32 | rank, kind="stable")  # hashes rise within a text
    pos = np.arange(len(h)) - np.repeat(bounds[:-1], sizes)
    size = np.repeat(sizes, sizes)
    near = pos < size - -(-t * size // 100) + 1
    by = by[near]
    return h[by], owner[near], size[near], pos[near], parts[by]


def entries(docs: DataFrame, order: Order, k: int, t: int, n: int, text: str = "text") -> DataFrame:
    """Prefix entries packed by shard; a task tells of equal sets once, as far as it remembers."""
    shared = arrow.shared(docs, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, seen = packed.Packer(COLUMNS, n), set()
        for batch in batches:
            for _, _, h, bounds in sets(batch, text, k):
                if len(seen) > 200_000:
                    seen.clear()
                node = signature(h, bounds)
                fresh = np.zeros(len(node), bool)
                for row, key in enumerate(node.tolist()):
                    if key not in seen:
                        seen.add(key)
                        fresh[row] = True
                g, owner, size, pos, parts = _prefix(h, bounds, shared.value, t)
                new = fresh[owner]
                g, size, pos, parts, node = g[new], size[new], pos[new], parts[new], node[owner[new]]
                part = (tv.mix(node.view(np.uint64)) % parts.astype(np.uint64)).astype(np.uint64)
                shard = (((g >> np.uint64(20)) + part) % np.uint64(n)).astype(np.int64)
                yield from packer.add(shard, h=g, node=node, size=size, pos=pos.astype(np.uint32) | np.where(parts > 1, _SPLIT, np.uint32(0)))
        yield from packer.flush()

    return arrow.mapped(docs.select(text), run, packed.schema(COLUMNS))


def possible(sa: np.ndarray, sb: np.ndarray, pa_: np.ndarray, pb: np.ndarray, t: int) -> np.ndarray:
    """Pairs whose lengths, and lengths left after the shared n-gram, can reach t."""
    need = -(-t * (sa + sb) // (100 + t))
    room = np.minimum(pa_, pb) + np.minimum(sa - pa_, sb - pb)
    return (100 * np.minimum(sa, sb) >= t * np.maximum(sa, sb)) & (room >= need)


def propose(shard: dict[str, np.ndarray], t: int) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(a, b) pairs of a shard, and the entries of its heavy and its split groups."""
    order = np.lexsort((shard["node"], shard["size"], shard["h"]))
    h, node = shard["h"][order], shard["node"][order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (node[1:] != node[:-1])]  # equal sets from several tasks
        order, h, node = order[new], h[new], node[new]
    split = (shard["pos"][order] & _SPLIT) > 0
    size, pos = shard["size"][order].astype(np.int64), (shard["pos"][order] & ~_SPLIT).astype(np.int64)
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    count = np.diff(np.r_[start, len(h)])
    some = (count > 1) | split[start]
    many = np.repeat(some, count)
    h, node, size, pos, split, group = (x[many] for x in (h, node, size, pos, split, np.repeat(count, count)))
    count = count[some]
    start = np.cumsum(count) - count
    first = np.repeat(start, count)
    left, right = [], []
    index = np.arange(len(h))
    for step in range(1, LIGHT):  # neighbours at this distance; at distance one for heavy groups too
        i = index[: max(0, len(h) - step)]
        i = i[(first[i] == first[i + step]) & ((group[i] <= LIGHT) | (step == 1))]
        left.append(i)
        right.append(i + step)
    heavy = index[group > LIGHT]
    left.append(first[heavy])
    right.append(heavy)
    a, b = np.concatenate(left), np.concatenate(right)
    ok = possible(size[a], size[b], pos[a], pos[b], t) & (node[a] != node[b])
    a, b = node[a[ok]], node[b[ok]]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    told = index[(group > LIGHT) | split]
    return pairs[:, 0], pairs[:, 1], {"key": h[told].view(np.int64), "node": node[told], "size": size[told], "pos": pos[told]}


def candidates(dealt: DataFrame, t: int) -> DataFrame:
    """Rows (a, b) for proposed pairs and (key, node, size, pos) for heavy groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "key", "node", "size", "pos"]
        for shard in packed.unpack(batches, COLUMNS):
            a, b, heavy = propose(shard, t)
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none, none, none], names=names)
            none = pa.nulls(len(heavy["key"]), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *(pa.array(heavy[c]) for c in names[2:])], names=names)

    return arrow.mapped(dealt, run, "a long, b long, key long, node long, size long, pos long")


def wanted_texts(docs: DataFrame, ids: DataFrame, k: int, text: str, doc: str) -> DataFrame:
    """(node, text) of at least the documents whose ids are the column ``rep`` of ``ids``."""
    shared = arrow.shared(docs, bitmap.build(ids, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(doc).cast(pa.int64())
            some = bitmap.passes(shared.value, own.fill_null(0).to_numpy(zero_copy_only=False)) & own.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(some))
            for i, j, h, bounds in sets(batch, text, k):
                yield pa.RecordBatch.from_arrays([pa.array(signature(h, bounds)), batch.column(text).slice(i, j - i)], names=["node", "text"])

    return scratch.table(arrow.mapped(docs.select(doc, text), run, "node long, text string"), "jaccard-texts")


def verify(pairs: DataFrame, texts: DataFrame, k: int, t: int, sets: Sets = sets) -> DataFrame:
    """Links (a, b) that connect what is t similar among the pairs (a, b), and more
    that their trees hold.  ``texts`` has (node, text); ``sets`` makes n-grams of texts.

    A tree has a leader ``a`` and some of its partners; its size is bounded by
    ``TREE`` and, where the pairs have b's size ``n``, by ``TREE_GRAMS``.
    """
    sized = "n" in pairs.columns
    parts = F.ceil(F.count("*") / TREE)
    parts = F.greatest(parts, F.ceil(F.sum("n") / TREE_GRAMS)) if sized else parts
    # written, so that the join below shuffles both sides and can be split where it is skewed
    sizes = scratch.table(pairs.groupBy("a").agg(parts.cast("long").alias("parts")), "tree-sizes")
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    wanted = dealt.select(F.col("b").alias("node"), "a", "part").union(dealt.select(F.col("a").alias("node"), "a", "part")).distinct()
    rows = texts.join(scratch.table(wanted, "tree-sets"), "node").select("a", "part", "node", "text")
    ordered = rows.repartition(packed.shards(texts), "a", "part").sortWithinPartitions("a", "part", "node")

    def linked(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        a, part, node, size, h = (np.concatenate(x) for x in zip(*held, strict=True))
        tree = np.cumsum(np.r_[False, (a[1:] != a[:-1]) | (part[1:] != part[:-1])])
        i, j = prefix_tree.links(tree, h, size, t)
        x, y = node[i], node[j]
        apart = x != y
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[apart]), pa.array(np.maximum(x, y)[apart])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        total = 0
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in ("a", "part", "node")]
            for i, j, h, bounds in sets(batch, "text", k):
                held.append((*(x[i:j] for x in ids), np.diff(bounds), h))
                total += len(h)
                if total < BATCH:
                    continue
                a, part, node, size, h = (np.concatenate(x) for x in zip(*held, strict=True))
                last = int(np.flatnonzero((a == a[-1]) & (part == part[-1]))[0])  # the last tree may go on
                if last:
                    edge = int(size[:last].sum())
                    yield linked([(a[:last], part[:last], node[:last], size[:last], h[:edge])])
                    a, part, node, size, h = a[last:], part[last:], node[last:], size[last:], h[edge:]
                held, total = [(a, part, node, size, h.copy())], len(h)
        if held:
            yield linked(held)

    return arrow.mapped(ordered, run, "a long, b long").distinct()


def _reach(t: int) -> str:
    """Whether lengths and the lengths left allow x and y to be similar."""
    room = f"least(x.pos, y.pos) + least(x.size - x.pos, y.size - y.pos) >= ceil({t} * (x.size + y.size) / {100 + t}d)"
    return f"100 * least(x.size, y.size) >= {t} * greatest(x.size, y.size) and {room}"


def pivots(known: DataFrame, t: int, turn: int) -> DataFrame:
    """(a, b): a set drawn from each group's largest component, and every set outside it."""
    drawn = F.min_by(F.struct("node", "size", "pos"), F.xxhash64("node", "key", F.lit(turn))).alias("p")
    main = known.groupBy("key", "comp").agg(F.count("*").alias("m"), drawn).groupBy("key").agg(F.max_by(F.struct("comp", "p"), F.struct("m", "comp")).alias("g"))
    main = scratch.table(main.select("key", F.col("g.comp").alias("comp"), "g.p.*"), "heavy-pivots")
    x, y = known.alias("x"), main.alias("y")
    return x.join(y, F.expr(f"x.key = y.key and x.comp != y.comp and {_reach(t)}")).select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()


def nearest(scored: DataFrame) -> DataFrame:
    """Each b's nearest partners; b has no more of them than n-grams in its prefix."""
    best = scored.groupBy("b").agg(F.slice(F.array_sort(F.collect_list(F.struct("apart", "a"))), 1, NEAREST).alias("near"), F.max("n").alias("n"))
    return best.select(F.explode("near.a").alias("a"), "b", "n")


def apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    side = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return joined.where("coalesce(ca, a) != coalesce(cb, b)").select(*pairs.columns)


@scratch.tidied
def join(docs: DataFrame, k: int = 5, t: int = 80, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``.

    k words an n-gram, t hundredths of similarity.
    """
    n = packed.shards(docs)
    summary = scratch.table(summarise(docs, k, text, doc), "jaccard-summary")
    order = Order(*frequent(summary))
    own = summary.where("h is null").select("doc", "n", "node", "bits")
    known = own.where("node is not null").groupBy("node").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    known = scratch.table(known, "jaccard-sets")
    found = scratch.table(candidates(packed.deal(entries(docs, order, k, t, n, text), n), t), "jaccard-candidates")
    pairs = scratch.table(cells.plausible(found.where("a is not null").select("a", "b").distinct(), known, t).select("a", "b", "n"), "jaccard-pairs")
    heavy = found.where("key is not null").select("key", "node", "size", "pos")
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(heavy.select("node")).distinct()
    texts = wanted_texts(docs, known.join(met, "node").select("rep"), k, text, doc)
    links = scratch.table(verify(pairs.groupBy("b").agg(F.min("a").alias("a"), F.max("n").alias("n")), texts, k, t), "jaccard-links")
    comps = scratch.table(graph.components(links), "jaccard-components")
    groups = cells.spanning(heavy, comps, "jaccard")
    for turn in range(ROUNDS):
        tried = pivots(groups, t, turn)
        if turn == 0:
            tried = tried.union(apart(pairs, comps).select("a", "b"))
        near = scratch.table(nearest(cells.plausible(tried.distinct(), known, t)), "jaccard-near")
        if near.isEmpty():
            break
        links = scratch.table(links.union(verify(near, texts, k, t)), "jaccard-links")
        comps = scratch.table(graph.components(links), "jaccard-components")
        groups = cells.spanning(groups, comps, "jaccard")
    more = cells.across(groups, known, t, n).union(apart(pairs, comps).select("a", "b")).distinct()
    more = scratch.table(more.join(known.select(F.col("node").alias("b"), "n"), "b").select("a", "b", "n"), "jaccard-across")
    if not more.isEmpty():
        links = links.union(scratch.table(verify(more, texts, k, t), "jaccard-links"))
    # rows with one id and different texts connect these
    twice = scratch.table(own.groupBy("doc").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("doc is not null and lo < hi").select("doc", "lo"), "jaccard-twice")
    same = own.select("doc", "node").join(twice, "doc").where("node != lo").select(F.col("lo").alias("a"), F.col("node").alias("b"))
    comps = scratch.table(graph.components(links.union(same)), "jaccard-components")
    named = known.select("node", "rep").join(comps, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("comp"))
    named = scratch.table(named, "jaccard-named")
    least = scratch.table(named.groupBy("comp").agg(F.min("rep").alias("component_id")), "jaccard-least")
    classes = scratch.table(named.join(least, "comp").select("node", "component_id"), "jaccard-classes")
    out = own.select("doc", "n", "node").join(classes, "node", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
