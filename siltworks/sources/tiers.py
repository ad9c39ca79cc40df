"""Tiers: sharded JSON lines with a manifest that commits them.

A tier lies in ``{root}/{tier}/{run_id}``.  Its manifest is written last; a
tier without one is incomplete.  Writing a tier replaces that run's earlier
output and nothing else.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import schemas
from ..functions.hashing import utc_now
from . import files, scratch

SHARD_ROWS = 50_000
VERSION = "0.1.0"


class UpstreamIncomplete(RuntimeError):
    """The tier that a stage reads has no manifest."""


class InvalidRecord(ValueError):
    """A record that breaks its tier's schema."""


def folder(root: str, tier: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{tier}/{run_id}"


def manifest_uri(root: str, tier: str, run_id: str) -> str:
    return f"{folder(root, tier, run_id)}/manifest.json"


def make_manifest(tier: str, run_id: str, stage: str, upstream: str | None, names: list[str], records_hash: str, read: int, written: int, drops: dict[str, int], allowed: tuple[str, ...]) -> dict[str, Any]:
    """A checked manifest: counts are conserved and every drop reason is known."""
    dropped = sum(drops.values())
    if read != written + dropped:
        raise ValueError(f"read {read} != written {written} + dropped {dropped}")
    if unknown := sorted(set(drops) - set(allowed)):
        raise ValueError(f"unknown drop reasons {unknown}")
    order = ("bronze", "silver", "gold")
    source = None if upstream is None else {"tier": order[order.index(tier) - 1], "manifest_uri": upstream}
    return {
        "tier": tier, "run_id": run_id, "created_at": utc_now(), "producer": {"stage": stage, "version": VERSION}, "input": source,
        "files": names, "records_hash": records_hash, "counts": {"read": read, "written": written, "dropped": dropped},
        "drops": [{"reason": k, "count": v} for k, v in sorted(drops.items())],
    }


def records_hash(spark: SparkSession, paths: list[str]) -> str:
    """sha256 of a single shard's bytes; of several, of their digests in order.

    Shards are hashed where they are read, so the driver sees a line per shard.
    """
    if not paths:
        return "sha256:" + hashlib.sha256(b"").hexdigest()
    rows = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("h")).collect()
    digests = [h for _, h in sorted((r["path"], r["h"]) for r in rows)]
    return "sha256:" + (digests[0] if len(digests) == 1 else hashlib.sha256("".join(digests).encode()).hexdigest())


def write_shards(df: DataFrame, target: str, total: int, shard_rows: int | None) -> list[str]:
    """Write rows in ``seq`` order, ``shard_rows`` to a file; seq counts from 0 without gaps.

    Files are staged beside the target and moved when all are there.
    """
    spark = df.sparkSession
    shards = max(1, -(-total // shard_rows)) if shard_rows else 1
    placed = df.withColumn("_shard", (F.col("seq") / F.lit(shard_rows or max(total, 1))).cast("int"))
    placed = placed.repartitionById(shards, "_shard").sortWithinPartitions("seq").drop("_shard", "seq")
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    placed.select(F.to_json(F.struct(*placed.columns), {"ignoreNullFields": "false"}).alias("value")).write.option("lineSep", "\n").text(staging)
    files.delete(spark, target)
    parts = [p for p in files.listing(spark, staging) if p.startswith("part-")]
    names = [f"records-{i:05d}.jsonl" for i in range(len(parts))]
    try:
        files.rename_all(spark, [(f"{staging}/{part}", f"{target}/{name}") for part, name in zip(parts, names, strict=True)])
    finally:
        files.delete(spark, staging)
    return names


def write_tier(df: DataFrame, root: str, tier: str, run_id: str, stage: str, upstream: str | None, drops: dict[str, int], allowed: tuple[str, ...], total: int, shard_rows: int | None = SHARD_ROWS) -> dict[str, Any]:
    target = folder(root, tier, run_id)
    names = write_shards(df, target, total, shard_rows)
    digest = records_hash(df.sparkSession, [f"{target}/{n}" for n in names])
    manifest = make_manifest(tier, run_id, stage, upstream, names, digest, total + sum(drops.values()), total, drops, allowed)
    files.write_new_json(df.sparkSession, manifest_uri(root, tier, run_id), manifest)  # of two writers of one run, one commits
    return manifest


def read_manifest(spark: SparkSession, root: str, tier: str, run_id: str) -> dict[str, Any]:
    found = files.read_json(spark, manifest_uri(root, tier, run_id))
    if found is None:
        raise UpstreamIncomplete(f"missing manifest: {manifest_uri(root, tier, run_id)}")
    return found


def _placed(lines: DataFrame, names: list[str]) -> DataFrame:
    """Add ``seq``: a line's place over all files, counting from 0.

    A scan cuts files into blocks; a row per block, with its number of lines, is
    all that is gathered.
    """
    spark = lines.sparkSession
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    block = {"_name": F.col("_metadata.file_name"), "_block": F.col("_metadata.file_block_start"), "_part": F.spark_partition_id(), "_at": at}
    tagged = lines.withColumns(block)
    found = tagged.groupBy("_name", "_block", "_part").agg(F.min("_at").alias("first"), F.count("*").alias("n")).collect()
    order = {name: i for i, name in enumerate(names)}
    before, starts = 0, []
    for r in sorted(found, key=lambda r: (order[r["_name"]], r["_block"])):
        starts.append((r["_name"], r["_block"], r["_part"], before - r["first"]))
        before += r["n"]
    known = spark.createDataFrame(starts or [("", -1, -1, 0)], "_name string, _block long, _part int, _shift long")
    placed = tagged.join(scratch.small(known, len(starts)), ["_name", "_block", "_part"])  # a row per block
    return placed.select("value", (F.col("_at") + F.col("_shift")).alias("seq"))


def read_tier(spark: SparkSession, root: str, tier: str, run_id: str) -> DataFrame:
    """A committed tier's records with ``seq``, their place in file and line order, in one scan of all files."""
    manifest = read_manifest(spark, root, tier, run_id)
    ddl = schemas.BRONZE_DDL if tier == "bronze" else schemas.SILVER_DDL
    base = folder(root, tier, run_id)
    lines = spark.read.option("lineSep", "\n").text([f"{base}/{name}" for name in manifest["files"]])
    fields = ", ".join(f for f in ddl.split(", ") if f != "seq bigint")
    return _placed(lines, manifest["files"]).withColumn("r", F.from_json("value", fields)).select("r.*", "seq")


def read_runs(spark: SparkSession, root: str, tier: str, run_ids: list[str]) -> DataFrame:
    """Committed tiers of several runs, one after the other, in one scan with one ``seq``.

    Scored records may have been written before ``modality_scores`` were added or after: the
    field is there for all, and null for those without it.
    """
    paths = [f"{folder(root, tier, run)}/{name}" for run in run_ids for name in read_manifest(spark, root, tier, run)["files"]]
    ddl = schemas.BRONZE_DDL if tier == "bronze" else schemas.SILVER_DDL.replace(schemas.EVALUATION, schemas.EVALUATION_WIDE)
    lines = spark.read.option("lineSep", "\n").text(paths)
    place = {run: i for i, run in enumerate(run_ids)}
    parts = lines.withColumns({"_run": F.element_at(F.split("_metadata.file_path", "/"), -2), "_file": F.col("_metadata.file_name")})
    at = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])
    block = {"_place": F.element_at(at, F.col("_run")), "_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}
    tagged = parts.withColumns(block)
    known = tagged.groupBy("_place", "_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    by = Window.orderBy("_place", "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = known.withColumn("_before", F.coalesce(F.sum("_n").over(by), F.lit(0))).drop("_n")  # a row per block
    placed = tagged.join(starts, ["_place", "_file", "_block"]).select("value", (F.col("_at") - F.col("_first") + F.col("_before")).alias("seq"))
    fields = ddl.removesuffix(", seq bigint")
    return placed.withColumn("r", F.from_json("value", fields)).select("r.*", "seq")


def first_invalid(df: DataFrame, valid: Column) -> DataFrame:
    """(id, seq) of the first record, by seq, that breaks the schema."""
    return df.where(~valid).select("id", "seq").orderBy("seq").limit(1)


def require_valid(df: DataFrame, valid) -> None:
    """Raise for the first record, by seq, that breaks the schema."""
    found = first_invalid(df, valid).collect()
    if found:
        raise InvalidRecord(f"invalid record {found[0]['id']}")
