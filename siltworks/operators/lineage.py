"""Lineage and conservation across tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def chain(manifests: DataFrame) -> DataFrame:
    """Each gold manifest with its silver and bronze ones, and whether counts carry over."""
    m = manifests.select("tier", "uri", F.col("input.manifest_uri").alias("up"), "counts.read", "counts.written")
    g, s, b = (m.where(F.col("tier") == t).alias(t) for t in ("gold", "silver", "bronze"))
    joined = g.join(s, F.col("gold.up") == F.col("silver.uri")).join(b, F.col("silver.up") == F.col("bronze.uri"))
    carried = (F.col("gold.read") == F.col("silver.written")) & (F.col("silver.read") == F.col("bronze.written"))
    return joined.select(F.col("gold.uri").alias("gold_uri"), F.col("silver.uri").alias("silver_uri"), F.col("bronze.uri").alias("bronze_uri"), carried.alias("conserved"))


def rows_to_sources(index: DataFrame, gold: DataFrame, bronze: DataFrame) -> DataFrame:
    """Every tensor row with its record and the place it came from."""
    at = gold.select(F.col("id").alias("record_id"), F.col("lineage.bronze_content_hash").alias("content_hash"))
    origin = bronze.select(F.col("id").alias("record_id"), F.col("source.uri").alias("uri"), F.col("source.locator").alias("locator"))
    return index.join(at, "record_id").join(origin, "record_id")


def unaccounted(read: DataFrame, *outcomes: DataFrame) -> DataFrame:
    """Ids that are in ``read`` but in no outcome, or the other way round, with multiplicity."""
    out = outcomes[0]
    for more in outcomes[1:]:
        out = out.unionByName(more)
    return read.exceptAll(out).withColumn("side", F.lit("lost")).unionByName(out.exceptAll(read).withColumn("side", F.lit("extra")))


def audited(records: DataFrame, run: str, reason: str, allowed: tuple[str, ...]) -> DataFrame:
    """(run, read, written, dropped, unknown, valid) of many runs' records at once.

    A record is written where ``reason`` is null.  ``unknown`` has the drop reasons that the stage does not
    know, in order; a run with one is not valid.  Counts are partial sums, so a run with most of the records is no
    hot key, and the reasons of a run are as many as there are kinds.
    """
    each = records.groupBy(F.col(run).alias("run"), F.col(reason).alias("reason")).agg(F.count("*").alias("n"))
    odd = F.when(F.col("reason").isNotNull() & ~F.col("reason").isin(*allowed), F.col("reason"))
    out = each.groupBy("run").agg(F.sum("n").alias("read"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("written"), F.array_sort(F.collect_set(odd)).alias("unknown"))
    return out.withColumn("dropped", F.col("read") - F.col("written")).withColumn("valid", F.size("unknown") == 0)
