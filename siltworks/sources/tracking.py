"""Experiment records: metrics, parameters, tags and artifacts of a stage's run.

A record is one JSON file, ``{root}/runs/{run_id}/{stage}/run.json``, its
artifacts lie beside it.  A rerun replaces both.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import utc_now
from . import files

DDL = "run_id string, stage string, logged_at string, metrics map<string,double>, params map<string,string>, tags map<string,string>, artifacts array<string>"


def folder(root: str, run_id: str, stage: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/{stage}"


def log(spark: SparkSession, root: str, run_id: str, stage: str, metrics: dict[str, float], params: dict[str, Any] | None = None, tags: dict[str, str] | None = None, artifacts: dict[str, bytes] | None = None) -> None:
    """Record a run; its identifier and stage are tags as well."""
    base = folder(root, run_id, stage)
    files.delete(spark, base)
    for name, data in (artifacts or {}).items():
        files.write_bytes(spark, f"{base}/artifacts/{name}", data)
    own = {"run_id": run_id, "stage": stage}
    record = own | {"logged_at": utc_now(), "metrics": metrics, "params": {k: str(v) for k, v in (params or {}).items()}, "tags": (tags or {}) | own, "artifacts": sorted(artifacts or {})}
    files.write_json(spark, f"{base}/run.json", record)  # last: it commits the record


def log_many(records: DataFrame, root: str) -> None:
    """Record many runs at once: (run_id, stage, metrics, params, tags), without artifacts.

    Executors write them as one batch; of a run and stage that several batches have, the last one's counts.
    """
    now = utc_now()
    own = F.create_map(F.lit("run_id"), F.col("run_id"), F.lit("stage"), F.col("stage"))
    others = F.map_filter("tags", lambda k, _: ~k.isin("run_id", "stage"))
    made = records.select("run_id", "stage", F.lit(now).alias("logged_at"), "metrics", "params", F.map_concat(others, own).alias("tags"), F.expr("cast(array() as array<string>)").alias("artifacts"))
    made.write.json(f"{root.rstrip('/')}/batches/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """All records below ``root``, those of batches included."""
    base, found = root.rstrip("/"), []
    if files.exists(spark, f"{base}/runs"):
        found.append(spark.read.schema(DDL).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "run.json").json(f"{base}/runs"))
    if files.exists(spark, f"{base}/batches"):
        rows = spark.read.schema(DDL).option("recursiveFileLookup", True).json(f"{base}/batches").withColumn("_batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        found.append(rows.groupBy("run_id", "stage").agg(F.max_by(F.struct(*rows.columns), "_batch").alias("r")).select(*[f"r.{c}" for c in rows.columns if c != "_batch"]))
    if not found:
        return spark.createDataFrame([], DDL)
    return reduce(DataFrame.unionByName, found)


def search(spark: SparkSession, root: str, tags: dict[str, str]) -> DataFrame:
    """Records that have all the tags."""
    found = scan(spark, root)
    for k, v in tags.items():
        found = found.where(F.col("tags").getItem(k) == v)
    return found


def one(spark: SparkSession, root: str, run_id: str, stage: str) -> dict[str, Any]:
    """The record of a run and stage; there must be exactly one."""
    rows = search(spark, root, {"run_id": run_id, "stage": stage}).limit(2).collect()
    if len(rows) != 1:
        raise KeyError(f"{len(rows) or 'no'} records of stage {stage} for {run_id}")
    return rows[0].asDict(recursive=True)
