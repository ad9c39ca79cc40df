"""The stages over tiers, and their command line.

Every stage reads a committed tier, writes the next and commits it with a
manifest.  Exit codes: 0 done, 1 unexpected, 2 configuration or schema, 3 no
records.  Stages that load models (train, smoke generation) take hooks.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..config import ConfigError, Pipeline, Train, load, merge_hyperparameters, parse
from ..functions.hashing import new_run_id, utc_now
from ..operators import clean as cleaning, ingest as ingesting, judge as judging, registry, smoke, tokenize as tokenizing
from ..sources import files, readers, registry as registry_files, scratch, tensors, tiers, tracking

STAGES = ("ingest", "clean", "judge", "tokenize")
#: A trainer gets (spark, config, root, run_id) and returns weights_uri,
#: base_model, tracking_id, final_train_loss and final_eval_loss.
Trainer = Callable[[SparkSession, Pipeline, str, str], dict[str, Any]]
#: A model loader is called once per task and gives a function from chat
#: messages to text.
Loader = Callable[[], Callable[[list[dict]], str]]


class Aborted(RuntimeError):
    """A stage that stops by one of its rules."""


class Empty(RuntimeError):
    """A stage without a record to write."""


def _staged(df: DataFrame, root: str, run_id: str, name: str) -> tuple[DataFrame, str]:
    """Write a frame that several outputs need, so that it is computed once."""
    path = f"{root.rstrip('/')}/staging/{run_id}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _dense(df: DataFrame) -> DataFrame:
    """seq counting from 0 without gaps, in its former order."""
    df = scratch.table(df, "ordered")  # else sampling and counting would make it again
    ordered = df.repartitionByRange("seq").sortWithinPartitions("seq")
    return readers.with_ordinal(ordered.drop("seq"), "seq").withColumn("seq", F.col("seq") - 1)


def _drops(df: DataFrame) -> dict[str, int]:
    return {r["drop_reason"]: r["n"] for r in cleaning.drop_counts(df).collect()}  # a row per reason


def ingest(spark: SparkSession, config: Pipeline, root: str, run_id: str, shard_rows: int = tiers.SHARD_ROWS) -> dict[str, Any]:
    now, frames = utc_now(), []
    for i, source in enumerate(config.ingest.sources):
        rows = readers.read(spark, source)
        if error := readers.first_error(rows):
            raise readers.MalformedRecord(f"{source.uri}: {error}")
        frames.append(ingesting.envelope(rows, run_id, F.lit(source.uri), source.type, now, i))
    if not frames:
        raise Empty("no sources")
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    files.delete(spark, tiers.folder(root, "bronze", run_id))
    staged, path = _staged(_dense(every), root, run_id, "bronze")
    total = staged.count()
    if not total:
        raise Empty("zero records ingested across all sources")
    manifest = tiers.write_tier(staged, root, "bronze", run_id, "ingest", None, {}, (), total, shard_rows)
    files.delete(spark, path)
    return manifest


def mappings(spark: SparkSession, config: Pipeline) -> DataFrame:
    """A row per source uri; of repeated uris the last counts."""
    rows = {s.uri: (s.uri, *((s.mapping.prompt_column, s.mapping.response_column, s.mapping.system_column) if s.mapping else (None,) * 3)) for s in config.ingest.sources}
    return spark.createDataFrame(list(rows.values()), "uri string, prompt_column string, response_column string, system_column string")


def clean(spark: SparkSession, config: Pipeline, root: str, run_id: str) -> dict[str, Any]:
    bronze = tiers.read_tier(spark, root, "bronze", run_id)
    tiers.require_valid(bronze, schemas.bronze_valid())
    files.delete(spark, tiers.folder(root, "silver", run_id))
    c = config.clean
    flagged, path = _staged(cleaning.clean(cleaning.map_records(bronze, mappings(spark, config)), c.pii, c.min_chars, c.max_chars), root, run_id, "silver")
    counts, drops = cleaning.counts(flagged).first(), _drops(flagged)
    if not counts["written"]:
        raise Empty("zero records survived cleaning")
    written = tiers.write_tier(_dense(cleaning.silver(flagged)), root, "silver", run_id, "clean", tiers.manifest_uri(root, "bronze", run_id), drops, schemas.CLEAN_REASONS, counts["written"])
    files.delete(spark, path)
    return written


def judge(spark: SparkSession, config: Pipeline, root: str, run_id: str, score: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, Any]:
    """``score`` adds score and reasoning; by default the endpoint named in the environment is asked."""
    if score is None:
        url = os.environ.get("SILTWORKS_JUDGE_URL", "")
        if not url or not config.judge.model:
            raise ConfigError("a judge needs judge.model and SILTWORKS_JUDGE_URL")
        j = config.judge
        score = lambda df: judging.score_http(df, url, j.model, os.environ.get("SILTWORKS_JUDGE_KEY", ""), j.max_concurrency, j.max_retries)
    silver = tiers.read_tier(spark, root, "silver", run_id)
    tiers.require_valid(silver, schemas.silver_valid())
    files.delete(spark, tiers.folder(root, "gold", run_id))
    flagged, path = _staged(judging.promoted(score(silver), config.judge.threshold), root, run_id, "gold")
    rate = judging.error_rate(flagged).first()
    if rate["abort"]:
        raise Aborted(f"judge errors {rate['errors']} of {rate['read']}")
    drops = _drops(flagged)
    written = rate["read"] - sum(drops.values())
    if not written:
        raise Empty("zero records promoted")
    metrics = judging.metrics(flagged).first().asDict()
    bins = "".join(f"{r['bin'] / 10:.1f} {r['n']}\n" for r in judging.histogram(flagged).orderBy("bin").collect())  # ten rows
    tracking.log(spark, root, run_id, "judge", metrics, {"model": config.judge.model, "threshold": config.judge.threshold}, {"experiment": config.train.mlflow_experiment}, {"histogram.txt": bins.encode()})  # before the tier commits
    gold = _dense(judging.gold(flagged, config.judge.model, utc_now()))
    manifest = tiers.write_tier(gold, root, "gold", run_id, "judge", tiers.manifest_uri(root, "silver", run_id), drops, schemas.JUDGE_REASONS, written)
    files.delete(spark, path)
    return manifest


def tokenize(spark: SparkSession, config: Pipeline, root: str, run_id: str) -> dict[str, Any]:
    make = tokenizing.adapter(config.model.adapter, config.model.tokenizer, config.model.revision)
    pad = tokenizing.pad_id(make())  # also fails early if the tokenizer cannot be loaded
    gold = tiers.read_tier(spark, root, "gold", run_id)
    tiers.require_valid(gold, schemas.gold_valid())
    target = f"{root.rstrip('/')}/artifacts/{run_id}"
    files.delete(spark, target)
    done, path = _staged(tokenizing.tokenized(gold, make, config.tokenize.max_seq_len), root, run_id, "tokens")
    rates = tokenizing.rates(done).first()
    if rates["abort"]:
        raise Aborted(f"over length {rates['over_rate']:.3f}, mismatched {rates['mismatch_rate']:.3f}")
    rows = tokenizing.with_row(tokenizing.with_split(done.where("drop_reason is null"), "id", config.tokenize.eval_fraction))
    index, index_path = _staged(rows.select("split", "row", F.col("id").alias("record_id"), "input_ids", "labels"), root, run_id, "index")
    if index.where("split = 'train'").isEmpty():
        raise Empty("the training split is empty")
    tensors.bundles(tokenizing.padded(index, pad)).write.parquet(f"{target}/tensors")
    index.select("split", "row", "record_id").write.parquet(f"{target}/index")
    done.where("drop_reason is not null").select(F.col("id").alias("record_id"), F.col("drop_reason").alias("reason")).write.parquet(f"{target}/dropped")
    record = {"run_id": run_id, "adapter": config.model.adapter, "tokenizer_id": config.model.tokenizer or config.model.adapter, "max_seq_len": config.tokenize.max_seq_len, "gold_manifest_uri": tiers.manifest_uri(root, "gold", run_id)}
    files.write_json(spark, f"{target}/index_map.json", record)  # last: it commits the artifact
    for p in (path, index_path):
        files.delete(spark, p)
    return record


def export_index_map(spark: SparkSession, root: str, run_id: str) -> str:
    """The whole row index as one JSON document, an entry a line; its path.  Executors sort and write it."""
    target = f"{root.rstrip('/')}/artifacts/{run_id}"
    record = files.read_json(spark, f"{target}/index_map.json")
    index = spark.read.parquet(f"{target}/index").select("split", F.col("row").cast("long"), "record_id")
    lost = spark.read.parquet(f"{target}/dropped").select("record_id", "reason")
    lost = readers.with_ordinal(scratch.table(lost, "dropped").repartitionByRange("record_id").sortWithinPartitions("record_id")).withColumn("row", F.col("n") - 1)
    fixed = [json.dumps(record, ensure_ascii=False)[:-1] + ', "splits": {"train": [', '], "eval": [', ']}, "dropped": [', "]}"]
    frame = spark.createDataFrame([(2 * i, 0, text) for i, text in enumerate(fixed)], "section int, row long, value string")

    def listed(rows: DataFrame, section: int, *columns: str) -> DataFrame:
        text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return rows.select(F.lit(section).alias("section"), "row", F.concat(F.when(F.col("row") > 0, ",").otherwise(""), text).alias("value"))

    parts = [listed(index.where(F.col("split") == s), 2 * i + 1, "row", "record_id") for i, s in enumerate(("train", "eval"))]
    for part in [*parts, listed(lost, 5, "record_id", "reason")]:
        frame = frame.unionByName(part)
    files.write_document(frame, f"{target}/index_map.full.json")
    return f"{target}/index_map.full.json"


def smoke_samples(spark: SparkSession, config: Pipeline, root: str, run_id: str) -> DataFrame:
    index = spark.read.parquet(f"{root.rstrip('/')}/artifacts/{run_id}/index")
    samples = smoke.sample(index, tiers.read_tier(spark, root, "gold", run_id), config.smoke.num_prompts)
    if samples.isEmpty():
        raise Empty("no evaluation records")
    return samples


def register(spark: SparkSession, config: Pipeline, root: str, run_id: str, weights_uri: str, losses: tuple[float, float], tracking_id: str, base_model: str) -> str:
    """Enter a trained version as a candidate."""
    return registry_files.put(spark, f"{root.rstrip('/')}/registry", {
        "model_version": f"{config.model.adapter}-{run_id}", "run_id": run_id, "adapter_name": config.model.adapter, "base_model": base_model, "method": config.train.method,
        "created_at": utc_now(), "gold_manifest_uri": tiers.manifest_uri(root, "gold", run_id), "index_map_uri": f"{root.rstrip('/')}/artifacts/{run_id}/index_map.json",
        "weights_uri": weights_uri, "mlflow_run_id": tracking_id, "hyperparameters": config.train.hyperparameters,
        "eval": {"final_train_loss": losses[0], "final_eval_loss": losses[1]}, "status": "candidate",
    })


def train(spark: SparkSession, config: Pipeline, root: str, run_id: str, trainer: Trainer) -> str:
    """Train by the given hook and register the result; gates come before the hook."""
    index = files.read_json(spark, f"{root.rstrip('/')}/artifacts/{run_id}/index_map.json")
    if index is None:
        raise tiers.UpstreamIncomplete(f"no tokenized artifact for {run_id}")
    if index["adapter"] != config.model.adapter:
        raise ConfigError(f"tokenized with adapter {index['adapter']!r}, configured {config.model.adapter!r}")
    made = trainer(spark, config, root, run_id)
    losses = {k: float(made[k]) for k in ("final_train_loss", "final_eval_loss")}
    tracking.log(spark, root, run_id, "train", losses, {"method": config.train.method} | config.train.hyperparameters, {"experiment": config.train.mlflow_experiment, "tracking_id": made["tracking_id"]}, made.get("artifacts"))
    return register(spark, config, root, run_id, made["weights_uri"], (made["final_train_loss"], made["final_eval_loss"]), made["tracking_id"], made["base_model"])


def train_many(runs: DataFrame, root: str, trainer: Callable[[DataFrame], DataFrame], method: str = Train.method, experiment: str = Train.mlflow_experiment) -> DataFrame:
    """Train many runs at once: (run_id, adapter_name, index_adapter) with ``refused`` (null: trained and registered).

    ``index_adapter`` is that of the run's tokenized artifact, null if there is none.  The trainer gets the
    runs that pass the gates and adds weights_uri, base_model, tracking_id, final_train_loss and
    final_eval_loss.  Metrics go to the run records and versions to the registry, each as a batch.
    """
    spark, base = runs.sparkSession, root.rstrip("/")
    mismatch = F.concat(F.lit("tokenized with adapter "), "index_adapter", F.lit(", configured "), "adapter_name")
    refused = F.when(F.col("index_adapter").isNull(), "no tokenized artifact").when(F.col("index_adapter") != F.col("adapter_name"), mismatch)
    gated = runs.withColumn("refused", refused)
    made = scratch.table(registry.named(trainer(gated.where("refused is null").drop("refused")), base), "trained")
    losses = F.struct(F.col("final_train_loss").cast("double").alias("final_train_loss"), F.col("final_eval_loss").cast("double").alias("final_eval_loss"))
    metrics = F.create_map(F.lit("final_train_loss"), losses["final_train_loss"], F.lit("final_eval_loss"), losses["final_eval_loss"])
    tags = F.create_map(F.lit("experiment"), F.lit(experiment), F.lit("tracking_id"), F.col("tracking_id"))
    tracking.log_many(made.select("run_id", F.lit("train").alias("stage"), metrics.alias("metrics"), F.create_map(F.lit("method"), F.lit(method)).alias("params"), tags.alias("tags")), base)
    registry_files.put_many(made.select(
        "model_version", "run_id", "adapter_name", "base_model", F.lit(method).alias("method"), F.lit(utc_now()).alias("created_at"), "gold_manifest_uri", "index_map_uri",
        "weights_uri", F.col("tracking_id").alias("mlflow_run_id"), F.expr("cast(map() as map<string,string>)").alias("hyperparameters"), losses.alias("eval"), "status",
    ), f"{base}/registry")
    return gated


def smoke_test(spark: SparkSession, config: Pipeline, root: str, run_id: str, base: Loader, tuned: Loader) -> dict[str, Any]:
    """Outputs of both models for a few evaluation prompts, as a transcript."""
    tracking.one(spark, root, run_id, "train")
    both = smoke.generated(smoke.generated(smoke_samples(spark, config, root, run_id), base, "base_output"), tuned, "tuned_output")
    rows = sorted((r.asDict(recursive=True) for r in both.collect()), key=lambda r: r.pop("row"))  # num_prompts rows
    transcript = {
        "run_id": run_id, "model_version": f"{config.model.adapter}-{run_id}",
        "generation": {"max_new_tokens": config.smoke.max_new_tokens, "strategy": "greedy"}, "samples": rows,
    }
    target = f"{root.rstrip('/')}/artifacts/{run_id}/smoke"
    files.delete(spark, target)
    files.write_json(spark, f"{target}/transcript.json", transcript)
    return transcript


def code_of(error: Exception) -> int:
    """The exit code of a stage that ends with an error."""
    if isinstance(error, Empty):
        return 3
    known = (ConfigError, readers.SourceError, readers.MalformedRecord, tokenizing.TokenizerError, tiers.UpstreamIncomplete, tiers.InvalidRecord, files.Conflict, registry_files.Refused, KeyError)
    return 2 if isinstance(error, known) else 1


def stage_code(f: Callable[[], Any], name: str) -> int:
    """Run a stage; its exit code.  Its scratch tables go when it ends."""
    held: list[str] = []
    try:
        with scratch.collected(held):
            f()
        return 0
    except Exception as e:
        print(f"{name}: {e}", file=sys.stderr)
        return code_of(e)
    finally:
        if held:
            scratch.delete(SparkSession.active(), held)


def outcomes(requests: DataFrame, work: Callable[[Pipeline, str], Any]) -> DataFrame:
    """Add ``gate`` (null: none) and ``code``: where a stage's runs stop, and their exit codes, for many runs at once.

    Requests have run_id, config (JSON), overrides (JSON of hyperparameters, or null), upstream (whether its
    manifest is there) and records (how many it has).  Gates come in this order, the first that fails counts; ``work``
    is called with the configuration and the run when all are passed.
    """

    def stopped(run_id: str, config: str | None, overrides: str | None, upstream: bool, records: int) -> tuple[str | None, int]:
        gate = "config"
        try:
            try:
                made = parse(json.loads(config or "null"))
            except json.JSONDecodeError as e:
                raise ConfigError(f"no JSON: {e}") from e
            gate = "hyperparameters"
            merge_hyperparameters(made.train.hyperparameters, json.loads(overrides or "{}"))
            gate = "adapter"
            load_tokenizer = tokenizing.adapter(made.model.adapter, made.model.tokenizer, made.model.revision)
            gate = "tokenizer"
            load_tokenizer()
            gate = "upstream"
            if not upstream:
                raise tiers.UpstreamIncomplete(f"no manifest for {run_id}")
            gate = "records"
            if not records:
                raise Empty(f"no records for {run_id}")
            gate = "work"
            work(made, run_id)
            return None, 0
        except Exception as e:
            return gate, code_of(e)

    @F.pandas_udf("gate string, code int")
    def run(run_id: pd.Series, config: pd.Series, overrides: pd.Series, upstream: pd.Series, records: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(map(stopped, run_id, config, overrides, upstream, records)), columns=["gate", "code"])

    flags = F.coalesce("upstream", F.lit(False)), F.coalesce("records", F.lit(0)).cast("long")
    return requests.withColumn("_o", run("run_id", "config", "overrides", *flags)).select(*requests.columns, "_o.gate", "_o.code")


def run(spark: SparkSession, config: Pipeline, root: str, run_id: str | None = None, score: Callable[[DataFrame], DataFrame] | None = None, trainer: Trainer | None = None, models: tuple[Loader, Loader] | None = None) -> int:
    """All stages in order, stopping at the first that fails; train and smoke run where their hooks are given."""
    run_id = run_id or new_run_id()
    steps: dict[str, Callable[[], Any]] = {
        "ingest": lambda: ingest(spark, config, root, run_id), "clean": lambda: clean(spark, config, root, run_id),
        "judge": lambda: judge(spark, config, root, run_id, score), "tokenize": lambda: tokenize(spark, config, root, run_id),
    }
    if trainer is not None:
        steps["train"] = lambda: train(spark, config, root, run_id, trainer)
        if models is not None:
            steps["smoke"] = lambda: smoke_test(spark, config, root, run_id, *models)
    for name in steps:
        if code := stage_code(steps[name], name):
            if code == 3:
                print(f"run: pipeline empty at {name}", file=sys.stderr)
            return code
    print(f"run: {run_id}")
    return 0


def registry_code(spark: SparkSession, root: str, operation: str, target: str | None, by: str) -> int:
    def act() -> None:
        if operation == "list":
            print("\n".join(registry.lines(registry_files.scan(spark, root))))
        elif not target:
            raise ConfigError(f"{operation} needs a version or an adapter")
        elif operation == "show":
            print(json.dumps(registry_files.show(spark, root, target), ensure_ascii=False, indent=2))
        else:
            version, adapter = (target, None) if operation == "promote" else (None, target)
            print("\n".join(registry_files.change(spark, root, operation, version, by, adapter)))

    return stage_code(act, f"registry {operation}")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="siltworks")
    p.add_argument("command", choices=[*STAGES, "run", "registry", "tools"])
    p.add_argument("--config", default="pipeline.yaml")
    p.add_argument("--root", default="tiers")
    p.add_argument("--run-id")
    p.add_argument("operation", nargs="?", choices=["list", "show", "promote", "rollback"], help="of the registry")
    p.add_argument("target", nargs="?", help="a model version, or the adapter to roll back")
    p.add_argument("--by", default=os.environ.get("USER", "system"), help="who asks for a transition")
    p.add_argument("--marked-judge", action="store_true", help="score by the marks in the texts")
    a = p.parse_args(argv)
    import re

    if a.run_id is not None and not re.match(schemas.RUN_RE, a.run_id) or a.command in STAGES and a.run_id is None:
        print(f"{a.command}: --run-id must match {schemas.RUN_RE}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("siltworks").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "registry":
        return registry_code(spark, f"{a.root.rstrip('/')}/registry", a.operation or "list", a.target, a.by)
    if a.command == "tools":
        from .tools import serve

        serve(spark, f"{a.root}/registry")
        return 0
    try:
        config = load(a.config)
    except ConfigError as e:
        print(f"{a.command}: {e}", file=sys.stderr)
        return 2
    score = judging.score_marked if a.marked_judge else None
    if a.command == "run":
        return run(spark, config, a.root, a.run_id, score)
    stages: dict[str, Callable[[], Any]] = {
        "ingest": lambda: ingest(spark, config, a.root, a.run_id), "clean": lambda: clean(spark, config, a.root, a.run_id),
        "judge": lambda: judge(spark, config, a.root, a.run_id, score), "tokenize": lambda: tokenize(spark, config, a.root, a.run_id),
    }
    return stage_code(stages[a.command], a.command)


if __name__ == "__main__":
    sys.exit(main())
