"""Mixing sources to target weights by hash thresholds.

Method: every document has a hash of 60 bits of its id.  A source's words are summed
by hash bucket; the bucket in which the running sum reaches the source's budget is
the boundary, and only it is split by the next ``BITS`` bits, level by level, until
single hashes are left.  A document is taken when its hash is under its source's
threshold: no sort, and a larger budget takes all that a smaller one takes.  Sources that
are wanted more than once give whole repeats and a threshold for the rest.

Weights go to sources in order of their names; what a source would have above ``most``
times its size goes to the others by weight.  The last hash is taken when that is
closer to the target; all sums are whole words, so nothing depends on task order.

Null texts count as empty, without words, and null sources as one source, the last.  Null
ids hash by the text.  Rows with one id are taken or left together.  Documents without
words have their source's whole repeats, which take nothing.  Only histograms are gathered by source, so one source
with most of the rows loads no task; thresholds are broadcast after a check of their number,
and joined by shuffle beyond it.  The table of sources has a row for each, which one task
puts in order.  An input column with the name of an added one is replaced; others
stay.  An empty table gives an empty one.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import scratch

#: Bits of the hash that a level looks at, and levels: 60 bits are 15 hexadecimal digits.
BITS, LEVELS = 12, 5
#: Sources whose thresholds are broadcast at most (some 20 MB).
BROADCAST_SOURCES = 100_000
_OWN = ["size", "source_size", "target", "copies"]


def sizes(docs: DataFrame, text: str, source: str, doc: str) -> DataFrame:
    """The documents with ``_source``, ``_size`` and ``_hash``."""
    key = F.coalesce(F.col(doc).cast("string"), F.concat(F.lit("text:"), F.col(text)), F.lit(""))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), key).cast("binary")), 1, 15), 16, 10).cast("long")
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.withColumns({"_source": F.col(source), "_size": words, "_hash": drawn})


def targets(measured: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(_source, source_size, target, base, budget): each source's share, whole repeats
    and the words that the threshold has to take; exact but for ``target``."""
    own = measured.groupBy("_source").agg(F.sum("_size").cast("decimal(20,0)").alias("s"))
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")).cast("decimal(10,0)")
    own = scratch.table(own.withColumn("w", weight), "mix-sources")
    total = own.agg(F.sum("s")).first()[0] or 0
    # Sources in order of the level at which they are full; those before the first that is not full at its own level are.
    by = Window.orderBy(F.col("ratio"), F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = own.withColumn("ratio", F.col("s").cast("double") / F.col("w").cast("double"))
    filled = filled.withColumns({"sb": F.coalesce(F.sum("s").over(by), F.lit(0)).cast("decimal(20,0)"), "wb": F.coalesce(F.sum("w").over(by), F.lit(0)).cast("decimal(20,0)")})
    weighed = own.agg(F.sum("w")).first()[0] or 0
    left = F.lit(total).cast("decimal(20,0)") - F.lit(most).cast("decimal(4,0)") * F.col("sb")
    share = F.lit(weighed).cast("decimal(20,0)") - F.col("wb")
    free = filled.withColumns({"left": left.cast("decimal(20,0)"), "share": share.cast("decimal(20,0)")})
    level = free.where(F.col("w") * F.col("left") <= F.lit(most).cast("decimal(4,0)") * F.col("s") * F.col("share")).orderBy("ratio", F.col("_source").asc_nulls_last()).select("left", "share").first()
    rest, over = (level["left"], level["share"]) if level else (0, 1)
    full = F.col("w") * F.lit(rest).cast("decimal(20,0)") > F.lit(most).cast("decimal(4,0)") * F.col("s") * F.lit(over).cast("decimal(20,0)")
    wanted = F.when(full, (most * F.col("s")).cast("decimal(24,0)")).otherwise((F.col("w") * F.lit(rest).cast("decimal(20,0)")).cast("decimal(34,0)"))
    under = F.when(full, F.lit(1).cast("decimal(20,0)")).otherwise(F.lit(over).cast("decimal(20,0)"))
    out = own.withColumns({"top": wanted, "under": under})
    out = out.withColumns({"target": F.col("top").cast("double") / F.col("under").cast("double"), "whole": F.expr("top div under"), "source_size": F.col("s").cast("long")})
    base = F.when(F.col("source_size") > 0, F.expr("whole div source_size")).otherwise(F.lit(0)).cast("long")
    out = out.withColumn("base", base)
    return out.select("_source", "source_size", "target", "base", (F.col("whole") - F.col("base") * F.col("source_size")).alias("budget"))


def _small(df: DataFrame, count: int) -> DataFrame:
    return F.broadcast(df) if count <= BROADCAST_SOURCES else df


def _bits(level: int) -> Column:
    return F.shiftrightunsigned("_hash", BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit((1 << BITS) - 1))


def thresholds(measured: DataFrame, shares: DataFrame, count: int) -> DataFrame:
    """(_s, below): the hash under which a source's documents are taken.

    Each level sums by source and bucket, finds the bucket in which the budget is
    reached, and goes on with the documents in it alone.
    """
    inside = measured.select(F.col("_source").alias("_s"), "_hash", "_size").where("_size > 0")
    state = shares.select(F.col("_source").alias("_s"), "budget", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("below"))
    ended: list[DataFrame] = []
    for level in range(LEVELS):
        inside = inside.withColumn("_bucket", _bits(level))
        hist = inside.groupBy("_s", "_bucket").agg(F.sum("_size").alias("in"))
        by = Window.partitionBy("_s").orderBy("_bucket")
        run = hist.withColumn("upto", F.sum("in").over(by))
        shift = BITS * (LEVELS - 1 - level)
        met = run.join(_small(state, count), run["_s"].eqNullSafe(state["_s"])).select(run["_s"], "_bucket", "in", "budget", "below", (F.col("before") + F.col("upto") - F.col("in")).alias("before"), (F.col("before") + F.col("upto")).alias("after"))
        # a bucket is passed when it fits, or when it is a single hash and taking it is closer
        passed = F.col("after") <= F.col("budget")
        if level == LEVELS - 1:
            passed = passed | (F.col("before") + F.col("after") < 2 * F.col("budget"))
        first = met.groupBy("_s").agg(F.min(F.when(~passed, F.struct("_bucket", "before"))).alias("x"), F.max("budget").alias("budget"), F.max("below").alias("below"))
        # where even the last hash is passed, the threshold is the end of the bucket that was split
        place = F.col("below") + F.coalesce("x._bucket", F.lit(1 << BITS)) * F.lit(1 << shift)
        state = scratch.table(first.select("_s", "budget", "x.before", place.alias("below"), F.col("x._bucket").alias("_at")), f"mix-boundary-{level}")
        if level < LEVELS - 1:
            held = _small(state.select(F.col("_s").alias("_t"), "_at"), count)
            inside = scratch.table(inside.join(held, inside["_s"].eqNullSafe(held["_t"]) & (F.col("_bucket") == F.col("_at")), "left_semi").select("_s", "_hash", "_size"), f"mix-inside-{level}")
            state = state.drop("_at")
    return state.select("_s", "below")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, text: str = "text", source: str = "source", doc: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies``, how often the mix has the document.

    ``weights`` go to the sources in order, again and again; ``carry`` names the columns to keep (all).
    """
    if not weights or min(weights) < 1 or most < 1:
        raise ValueError("weights and the most repeats are whole numbers of 1 or more")
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in _OWN]
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = dict(zip(docs.columns, plain.columns, strict=True))
    measured = scratch.table(sizes(plain, at[text], at[source], at[doc]).select(*[at[c] for c in kept], "_source", "_size", "_hash"), "mix-sizes")
    shares = scratch.table(targets(measured, weights, most), "mix-shares")
    count = shares.count()
    bounds = thresholds(measured, shares, count)
    plan = shares.join(bounds, shares["_source"].eqNullSafe(bounds["_s"]), "left").select(F.col("_source").alias("_t"), "source_size", "target", "base", "below")
    plan = scratch.table(plan, "mix-plan")
    more = F.when((F.col("_size") > 0) & (F.col("_hash") < F.col("below")), 1).otherwise(0)
    out = measured.join(_small(plan, count), measured["_source"].eqNullSafe(F.col("_t")), "left")
    return out.select(*[F.col(at[c]).alias(c) for c in kept], F.col("_size").alias("size"), "source_size", "target", (F.col("base") + more).cast("long").alias("copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
