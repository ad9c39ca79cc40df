"""Who may read and write what: requests against grants by the longest path that fits.

A grant names a principal, a path and a level: ``W`` (write, and with it read), ``R`` (read) or ``-``
(neither).  It holds for the path and all below it; of several the longest holds, and without one
nothing is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Grants that are broadcast at most (some 20 MB); beyond, requests meet them by shuffle.
BROADCAST_GRANTS = 100_000
ANYONE = "*"
#: Levels by strength: of two grants for one path the weaker holds.
LEVELS = ("-", "R", "W")


def prefixes(path: Column) -> Column:
    """The path and the paths above it, shortest first; the empty one is the root."""
    steps = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda s: s != "")
    return F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))


def decided(requests: DataFrame, grants: DataFrame) -> DataFrame:
    """Requests (principal, action, path) with ``level``, that of the grant that holds, and ``allowed``.

    Equal requests are decided once.  Each asks for its own prefixes by an equi-join, a few rows a request, so nothing
    is compared that cannot fit.  Grants to ``*`` hold for every principal; of grants for one path, a principal's own comes first.
    Requests without a principal have only what everyone has.
    """
    rank = lambda c: F.array_position(F.array(*[F.lit(x) for x in LEVELS]), c)
    clean = grants.select(F.col("principal").alias("_who"), F.array_join(F.filter(F.split("path", "/"), lambda s: s != ""), "/").alias("_path"), F.col("level").alias("_level"))
    held = clean.where(F.col("_level").isin(*LEVELS)).groupBy("_who", "_path").agg(F.min_by("_level", rank(F.col("_level"))).alias("_level"))
    if held.count() <= BROADCAST_GRANTS:
        held = F.broadcast(held)
    asked = requests.select("principal", "path").distinct()
    who = F.array_distinct(F.array_compact(F.array(F.col("principal"), F.lit(ANYONE))))
    each = asked.withColumn("_p", F.explode(prefixes(F.col("path")))).withColumn("_w", F.explode(who))
    met = each.join(held, (F.col("_p") == F.col("_path")) & (F.col("_w") == F.col("_who")))
    depth = F.when(F.col("_path") == "", 0).otherwise(F.size(F.split("_path", "/")))
    best = met.groupBy("principal", "path").agg(F.max_by("_level", F.struct(depth.alias("d"), (F.col("_who") != ANYONE).alias("o"))).alias("level"))
    named = best.select(F.col("principal").alias("_a"), F.col("path").alias("_b"), "level")
    out = requests.join(named, F.col("principal").eqNullSafe(F.col("_a")) & F.col("path").eqNullSafe(F.col("_b")), "left").drop("_a", "_b")
    level = F.coalesce("level", F.lit("-"))
    allowed = (level == "W") & F.col("action").isin("read", "write") | (level == "R") & (F.col("action") == "read")
    return out.withColumns({"level": level, "allowed": F.coalesce(allowed, F.lit(False))})


def mismatches(observed: DataFrame, grants: DataFrame) -> DataFrame:
    """Requests whose observed answer (``granted``) is not what the grants say."""
    return decided(observed, grants).where(F.col("granted") != F.col("allowed"))
