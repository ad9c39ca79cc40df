"""Media that records refer to: does each exist, is it of an allowed kind, is it small enough.

A file's size and name come from a listing alone; no content is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Parts into which the verdict on one asset is copied, so that an asset of very many records is met in as many places.
SPREAD = 16


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(uri, size) of the files below ``root``, whose uris are under ``root`` as it is given.

    The scan has no content column, so only the file system's metadata is read.
    """
    base = root.rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    place = F.substring_index("path", base.split(":", 1)[-1].lstrip("/") + "/", -1)
    return found.select(F.concat(F.lit(base + "/"), place).alias("uri"), F.col("length").alias("size"))


def extension(uri: Column) -> Column:
    """What follows the last dot of the last name, in lower case."""
    name = F.element_at(F.split(uri, "/"), -1)
    return F.when(F.instr(name, ".") > 0, F.lower(F.element_at(F.split(name, r"\."), -1))).otherwise(F.lit(""))


def references(records: DataFrame, seq: str = "seq") -> DataFrame:
    """(seq, uri) of every part that is no text."""
    parts = F.filter(F.flatten(F.transform("conversation", lambda t: t["content"])), lambda p: p["type"] != "text")
    return records.select(F.col(seq).alias("_seq"), F.explode(F.transform(parts, lambda p: p["value"])).alias("uri"))


def tested(flagged: DataFrame, files: DataFrame, allowed: Sequence[str], most: int, seq: str = "seq") -> DataFrame:
    """Add the drop reason ``bad_asset`` to records that passed so far and refer to a bad asset.

    An asset is bad if it is not listed, its extension is not ``allowed``, or it has more than ``most`` bytes;
    a part without a uri is bad too.  ``flagged`` has ``conversation``, ``drop_reason`` and the unique ``seq``.
    Each asset is judged once, and its verdict copied ``SPREAD`` times for the join with the references, which
    are dealt by record: an asset that many records share is no hot key.  Records come back by ``seq``.
    """
    passed = references(flagged.where("drop_reason is null"), seq)
    used = passed.select("uri").distinct()
    ok = F.col("size").isNotNull() & (F.col("size") <= most) & extension(F.col("uri")).isin(*allowed)
    bad = used.join(files.select("uri", "size"), "uri", "left").where(~F.coalesce(ok, F.lit(False))).select(F.col("uri").alias("_bad"))
    spread = bad.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    dealt = passed.withColumn("_part", F.pmod(F.xxhash64("_seq"), F.lit(SPREAD)).cast("int"))
    found = dealt.join(spread, (dealt["_part"] == spread["_part"]) & dealt["uri"].eqNullSafe(spread["_bad"]), "left_semi")
    hit = found.select("_seq").distinct().withColumn("_hit", F.lit(True))
    joined = flagged.join(hit, F.col(seq) == F.col("_seq"), "left")
    return joined.withColumn("drop_reason", F.when(F.col("_hit") & F.col("drop_reason").isNull(), "bad_asset").otherwise(F.col("drop_reason"))).drop("_seq", "_hit")
