"""Bronze: raw rows in an envelope that says where they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import hash_json, record_id

VERSION = "0.1.0"
#: seq of a source's first row is its index in the configuration times this.
SOURCE_ROWS = 1 << 40


def envelope(rows: DataFrame, run_id: str, uri: Column, kind: str, ingested_at: str, source_index: int = 0) -> DataFrame:
    """Bronze records of rows (n, raw): ids are made from run, source and place."""
    at = F.col("n") - 1 if kind == "sql" else F.col("n")
    locator = F.concat(F.lit({"csv": "row:", "sql": "offset:"}.get(kind, "line:")), at.cast("long").cast("string"))
    source = F.struct(uri.alias("uri"), F.lit(kind).alias("type"), locator.alias("locator"), F.lit(ingested_at).alias("ingested_at"), F.lit(VERSION).alias("ingestor_version"))
    return rows.select(
        record_id(F.lit(run_id), uri, locator).alias("id"), F.lit(run_id).alias("run_id"), source.alias("source"),
        hash_json(F.col("raw")).alias("content_hash"), "raw", (F.lit(source_index * SOURCE_ROWS) + F.col("n") - 1).cast("long").alias("seq"),
    )


def shard_of(seq: Column, shard_rows: int) -> Column:
    return F.floor(seq / F.lit(shard_rows)).cast("long")
