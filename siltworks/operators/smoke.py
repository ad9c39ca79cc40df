"""Before and after: sample evaluation records and generate for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.conversation import chat_messages


def sample(index: DataFrame, gold: DataFrame, num_prompts: int = 8) -> DataFrame:
    """The first ``num_prompts`` evaluation rows: row, record_id, prompt_messages, reference.

    ``index`` has (split, row, record_id); of records with one id the last counts.
    """
    wanted = index.where("split = 'eval'").orderBy("row").limit(num_prompts).select("row", "record_id")
    last = gold.groupBy("id").agg(F.max_by("conversation", "seq").alias("conversation"))
    found = last.join(F.broadcast(wanted), last["id"] == wanted["record_id"])  # at most num_prompts rows
    m = F.col("_m")
    staged = found.withColumn("_m", chat_messages(F.col("conversation")))
    return staged.select("row", "record_id", F.slice(m, F.lit(1), F.size(m) - 1).alias("prompt_messages"), F.element_at(m, -1)["content"].alias("reference"))


def missing(index: DataFrame, gold: DataFrame) -> DataFrame:
    """Index entries without a record."""
    return index.select("record_id").distinct().join(gold.select(F.col("id").alias("record_id")), "record_id", "left_anti")


def similarity(output: Column, reference: Column) -> Column:
    """Twice the words that both have over the words of each, distinct, in whole thousandths; two without words agree."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    both = F.struct(words(output).alias("a"), words(reference).alias("b"))
    shared = lambda x: F.size(F.array_intersect(x["a"], x["b"]))
    total = lambda x: F.size(x["a"]) + F.size(x["b"])
    score = F.transform(F.array(both), lambda x: F.when(total(x) > 0, F.floor(2000 * shared(x) / total(x))).otherwise(F.lit(1000)))[0]
    return score.cast("long")


def regression(samples: DataFrame, versions: DataFrame, promotions: DataFrame) -> DataFrame:
    """(model_version, adapter_name, n, score, baseline, baseline_score, change): each version against the last promoted before it.

    ``samples`` has (model_version, tuned_output, reference), ``versions`` (model_version, adapter_name, created_at),
    ``promotions`` (adapter_name, at, model_version).  Scores are means of ``similarity``, rounded down.  A promotion at the
    very time at which a version was made comes after it; of promotions at one time that of the greatest version is
    the last.   Versions without samples have no score, and the
    first ones no baseline.  The as-of join is a running last value over both kinds of rows, not a range join.
    """
    means = samples.groupBy("model_version").agg(F.count("*").alias("n"), F.floor(F.avg(similarity(F.col("tuned_output"), F.col("reference")))).alias("score"))
    ours = versions.select("adapter_name", F.col("created_at").alias("at"), F.lit(0).alias("kind"), "model_version")
    rows = ours.unionByName(promotions.select("adapter_name", "at", F.lit(1).alias("kind"), "model_version"))
    by = Window.partitionBy("adapter_name").orderBy("at", "kind", "model_version")
    promoted = F.when(F.col("kind") == 1, F.col("model_version"))
    asof = rows.withColumn("baseline", F.last(promoted, ignorenulls=True).over(by)).where("kind = 0").select("model_version", "adapter_name", "baseline")
    base = means.select(F.col("model_version").alias("baseline"), F.col("score").alias("baseline_score"))
    out = asof.join(means, "model_version", "left").join(base, "baseline", "left")
    return out.select("model_version", "adapter_name", F.coalesce("n", F.lit(0)).alias("n"), "score", "baseline", "baseline_score", (F.col("score") - F.col("baseline_score")).alias("change"))


def generated(samples: DataFrame, make: Callable[[], Callable[[list[dict]], str]], name: str) -> DataFrame:
    """Add a model's outputs as column ``name``; ``make`` loads the model once per task."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.schema) + f", `{name}` string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            yield frame.assign(**{name: [model(list(m)) for m in frame["prompt_messages"]]})

    return samples.mapInPandas(run, schema)
