"""The model registry: one manifest per model version, read tolerantly."""

from __future__ import annotations

import time
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.hashing import utc_now
from . import files, scratch

#: The folder of versions that were registered many at once.
BATCHES = "batches"


class Refused(ValueError):
    """A transition that the registry's state does not allow."""


def _parsed(rows: DataFrame) -> DataFrame:
    """The manifest and ``valid`` of rows (key, text, ...); the text is dropped."""
    ddl = schemas.REGISTRY_DDL
    names = sorted(f.name for f in schemas.ddl(ddl).fields)
    every = F.array(*[F.lit(n) for n in names])
    first = F.array(*[F.lit(n) for n in names if n not in schemas.REGISTRY_LATER])
    keys = F.json_object_keys("text")
    fits = (F.size(F.array_except(keys, every)) == 0) & (F.size(F.array_except(first, keys)) == 0) & (F.size(keys) == F.size(F.array_distinct(keys)))
    known = F.coalesce(fits, F.lit(False))
    parsed = rows.withColumn("m", F.from_json("text", ddl))
    return parsed.select("key", "m.*", known.alias("known")).withColumn("valid", F.col("known") & schemas.registry_valid()).drop("known")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """Every ``manifest.json`` below ``root``: its key, the parsed manifest and whether it is valid.

    Bytes that are no UTF-8, text that is no JSON, and manifests with missing,
    mistyped or unknown fields are rows like any other, with ``valid`` false.
    Versions of batches (see ``put_many``) are rows as well; of a version, what was written last counts.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    key = F.regexp_replace(F.substring_index("path", base + "/", -1), "^/+", "")
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    rows = raw.select(key.alias("key"), text.alias("text"), F.unix_millis("modificationTime").alias("at"))
    batches = f"{root.rstrip('/')}/{BATCHES}"
    if files.exists(spark, batches):
        place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        many = spark.read.schema("key string, text string").option("recursiveFileLookup", "true").json(batches)
        many = many.select("key", "text", (F.substring_index(place, "-", 1).cast("long") / 1_000_000).cast("long").alias("at"), place.alias("batch"))
        rows = rows.withColumn("batch", F.lit("~")).unionByName(many)  # of the same time, the file counts
        rows = rows.groupBy("key").agg(F.max_by("text", F.struct("at", "batch", "text")).alias("text"))
    return _parsed(rows)


def put_many(manifests: DataFrame, root: str) -> None:
    """Register many versions at once, rows of manifests; executors write them as one batch."""
    key = F.concat("model_version", F.lit("/manifest.json"))
    rows = manifests.select(key.alias("key"), F.to_json(F.struct(*manifests.columns)).alias("text"))
    rows.write.option("compression", "gzip").json(f"{root.rstrip('/')}/{BATCHES}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")


def put(spark: SparkSession, root: str, manifest: dict[str, Any]) -> str:
    """Register a version: its folder is cleared, the manifest written."""
    path = f"{root.rstrip('/')}/{manifest['model_version']}"
    files.delete(spark, path)
    files.write_json(spark, f"{path}/manifest.json", manifest)
    return f"{path}/manifest.json"


def change(spark: SparkSession, root: str, op: str, model_version: str | None, by: str, adapter_name: str | None = None) -> list[str]:
    """Promote a version or roll an adapter back, rewriting the manifests that change; their versions.

    Registry writes are last-writer-wins: the tool is for one operator at a time.
    """
    from ..operators import registry

    found = scan(spark, root).where("valid")
    asked = get(spark, root, model_version) if op == "promote" else {}
    adapter_name = asked.get("adapter_name", adapter_name)
    there = op != "promote" or files.exists(spark, asked["weights_uri"])
    retired = F.transform(F.filter("history", lambda h: h["to"] == "retired"), lambda h: h["at"])
    versions = found.select("model_version", "adapter_name", "status", "superseded_by", "history", F.lit(there).alias("weights"), F.array_max(retired).alias("retired_at"))
    request = spark.createDataFrame([(adapter_name, utc_now(), 0, op, model_version, by)], "adapter_name string, at string, seq long, op string, model_version string, by string")
    outcome = scratch.table(registry.judged(versions.where(F.col("adapter_name") == adapter_name), request), "change")
    refused = outcome.first()["refused"]
    if refused:
        raise Refused(f"{op} {model_version or adapter_name}: {refused}")
    changed = registry.after(versions, outcome).join(outcome.select(F.explode(F.array("gone_up", "gone_down")).alias("model_version")), "model_version", "left_semi")
    rows = changed.collect()  # two at most
    for r in rows:
        manifest = get(spark, root, r["model_version"]) | {k: r.asDict(recursive=True)[k] for k in ("status", "superseded_by", "history")}
        files.write_json(spark, f"{root.rstrip('/')}/{r['model_version']}/manifest.json", manifest)
    return sorted(r["model_version"] for r in rows)


def show(spark: SparkSession, root: str, model_version: str) -> dict[str, Any]:
    """A version's manifest; its weights must be there."""
    manifest = get(spark, root, model_version)
    if not files.exists(spark, manifest["weights_uri"]):
        raise Refused(f"show {model_version}: missing weights")
    return manifest


def get(spark: SparkSession, root: str, model_version: str) -> dict[str, Any]:
    found = files.read_json(spark, f"{root.rstrip('/')}/{model_version}/manifest.json")
    if files.exists(spark, f"{root.rstrip('/')}/{BATCHES}"):  # one of them may be newer
        rows = scan(spark, root).where(F.col("valid") & (F.col("key") == f"{model_version}/manifest.json")).drop("key", "valid").limit(1).collect()
        found = {k: v for k, v in rows[0].asDict(recursive=True).items() if v is not None} if rows else found
    if found is None:
        raise KeyError(f"unknown model_version: {model_version}")
    return found
