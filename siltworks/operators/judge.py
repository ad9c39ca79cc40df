"""Gold: promote records by score; metrics and aborts."""

from __future__ import annotations

import json
import random
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.conversation import rubric_prompt
from ..functions.replies import DEFAULT_SCORE, MARKS, normalised, parse
from ..sources import scratch

#: Share of judge errors beyond which a run aborts; delays in seconds (fixed values).
MAX_ERRORS, BASE_DELAY, MAX_DELAY = 0.10, 2.0, 60.0


def promoted(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Add ``normalized`` and ``drop_reason``; ``score`` is 1 to 10, or null for a judge error."""
    norm = scored.withColumn("normalized", normalised(F.col("score")))
    reason = F.when(F.col("score").isNull(), "judge_error").when(F.col("normalized") < F.lit(threshold), "below_threshold")
    return norm.withColumn("drop_reason", reason)


def gold(flagged: DataFrame, judge_model: str, evaluated_at: str) -> DataFrame:
    value = F.struct(F.col("normalized").alias("score"), F.lit(judge_model).alias("judge_model"), F.col("reasoning").alias("reasoning"), F.lit(evaluated_at).alias("evaluated_at"))
    return flagged.where("drop_reason is null").select("id", "run_id", "lineage", "conversation", value.alias("evaluation"), "seq")


def with_modality(scored: DataFrame, found: DataFrame, least: dict[str, float], threshold: float = 0.7) -> DataFrame:
    """``promoted`` with a veto: add ``modality_scores``, and the reason ``vetoed`` before the rubric's.

    ``found`` has evaluators' scores (id, modality, score), any number for a record; the least of a
    modality counts.  What a record's ``evaluation`` already has is merged, and the newer score counts.  A record is
    vetoed if a score is under its modality's ``least``; modalities without one never veto, and
    records without scores are judged by the rubric alone.  Scores that are null are none.
    """
    each = found.where("score is not null").groupBy("id", "modality").agg(F.min("score").alias("score"))
    own = each.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("modality", "score")))).alias("_new"))
    empty = F.create_map().cast("map<string,double>")
    joined = promoted(scored, threshold).join(own, "id", "left")
    former = F.coalesce(F.col("evaluation.modality_scores"), empty) if "evaluation" in scored.columns and "modality_scores" in scored.schema["evaluation"].dataType.names else empty
    new = F.coalesce("_new", empty)
    merged = F.map_concat(F.map_filter(former, lambda k, _: ~F.map_contains_key(new, k)), new)
    limits = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]).cast("map<string,double>") if least else empty
    veto = F.exists(F.map_entries(F.col("modality_scores")), lambda e: F.coalesce(e["value"] < F.try_element_at(limits, e["key"]), F.lit(False)))
    out = joined.withColumn("modality_scores", merged).drop("_new")
    return out.withColumn("drop_reason", F.when(veto, "vetoed").otherwise(F.col("drop_reason")))


def gold_wide(flagged: DataFrame, judge_model: str, evaluated_at: str) -> DataFrame:
    """``gold`` with the modality scores in the evaluation, an addition that earlier tiers lack."""
    value = F.struct(
        F.col("normalized").alias("score"), F.lit(judge_model).alias("judge_model"), F.col("reasoning").alias("reasoning"), F.lit(evaluated_at).alias("evaluated_at"),
        F.when(F.size("modality_scores") > 0, F.col("modality_scores")).alias("modality_scores"),
    )
    return flagged.where("drop_reason is null").select("id", "run_id", "lineage", "conversation", value.alias("evaluation"), "seq")


def error_rate(flagged: DataFrame, most: float = MAX_ERRORS) -> DataFrame:
    """read, errors, rate and whether the run must abort: strictly more than ``most``."""
    out = flagged.agg(F.count("*").alias("read"), F.count_if(F.col("drop_reason") == "judge_error").alias("errors"))
    rate = F.coalesce(F.try_divide(F.col("errors"), F.col("read")), F.lit(0.0))
    return out.withColumn("rate", rate).withColumn("abort", rate > most)


def metrics(flagged: DataFrame) -> DataFrame:
    """Mean and median of scored records, promotion and error rates; 0 where there is nothing."""
    out = flagged.agg(
        F.coalesce(F.avg("normalized"), F.lit(0.0)).alias("mean_score"), F.coalesce(F.median("normalized"), F.lit(0.0)).alias("median_score"),
        F.count("*").alias("_n"), F.count_if(F.col("drop_reason").isNull()).alias("_p"), F.count_if(F.col("drop_reason") == "judge_error").alias("_e"),
    )
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("_n")), F.lit(0.0))
    return out.select("mean_score", "median_score", share("_p").alias("promotion_rate"), share("_e").alias("judge_error_rate"))


def bin_of(normalized: Column) -> Column:
    return F.least((normalized * 10).cast("int"), F.lit(9) + F.when(normalized.isNull(), F.lit(None).cast("int")).otherwise(0))


def histogram(flagged: DataFrame) -> DataFrame:
    """Ten bins of normalised scores, empty ones too; the last holds 0.9 and 1."""
    found = flagged.where("normalized is not null").groupBy(bin_of(F.col("normalized")).alias("bin")).agg(F.count("*").alias("n"))
    bins = flagged.sparkSession.range(10).select(F.col("id").cast("int").alias("bin"))
    return bins.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def backoff(attempt: int, rng: random.Random) -> float:
    return rng.uniform(0, min(MAX_DELAY, BASE_DELAY * 2 ** (attempt - 1)))


def _post(url: str, key: str, body: dict) -> tuple[int | None, object]:
    """(status, JSON reply); status None for a failed connection."""
    headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    request = urllib.request.Request(url.rstrip("/") + "/v1/chat/completions", json.dumps(body).encode(), headers)
    try:
        with urllib.request.urlopen(request, timeout=30) as reply:
            return reply.status, json.loads(reply.read())
    except urllib.error.HTTPError as e:
        return e.code, None
    except (OSError, ValueError):
        return None, None


def ask(post: Callable[[dict], tuple[int | None, object]], model: str, prompt: str, retries: int, rng: random.Random, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str] | None:
    """Score one prompt; retry on overload, server errors, lost connections and malformed replies."""
    body = {"model": model, "messages": [{"role": "user", "content": prompt}], "temperature": 0, "response_format": {"type": "json_object"}}
    for attempt in range(retries + 1):
        if attempt:
            sleep(backoff(attempt, rng))
        status, reply = post(body)
        if status is not None and status != 200 and status != 429 and not 500 <= status < 600:
            return None
        if status == 200:
            try:
                content = reply["choices"][0]["message"]["content"]  # type: ignore[index]
            except (KeyError, IndexError, TypeError):
                continue
            if isinstance(content, str) and (found := parse(content)):
                return found
    return None


#: A client posts a request's body and gives (status, JSON reply).
Client = Callable[[dict], tuple[int | None, object]]


def endpoint(url: str, key: str = "") -> Callable[[], Client]:
    return lambda: lambda body: _post(url, key, body)


def score_replies(silver: DataFrame, connect: Callable[[], Client], model: str, concurrency: int = 4, retries: int = 3, threads: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Add ``score`` and ``reasoning`` from a chat endpoint, by ``seq``.

    ``concurrency`` calls are made at once: so many tasks, or fewer with ``threads``
    calls each.  ``connect`` makes a task's client.  Replies are written to the
    scratch folder, so that no later use asks again; waits between tries are
    drawn from the record's number.
    """
    prompts = silver.select("seq", rubric_prompt(F.col("conversation")).alias("_prompt")).repartition(max(1, concurrency // threads))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        post = connect()
        one = lambda x: ask(post, model, x[1], retries, random.Random(int(x[0])), sleep) or (None, None)
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                found = list(pool.map(one, zip(frame["seq"], frame["_prompt"], strict=True)))
                yield pd.DataFrame({"seq": frame["seq"], "score": pd.array([s for s, _ in found], "Int32"), "reasoning": [r for _, r in found]})

    replies = scratch.table(prompts.mapInPandas(run, "seq long, score int, reasoning string"), "judge-replies")
    return silver.join(replies, "seq", "left")


def score_http(silver: DataFrame, url: str, model: str, key: str = "", concurrency: int = 4, retries: int = 3) -> DataFrame:
    """``score_replies`` of an endpoint by its URL."""
    return score_replies(silver, endpoint(url, key), model, concurrency, retries)


def stand_in() -> Client:
    """An offline judge that follows the marks in the text (see ``replies.MARKS``)."""
    failed: set[str] = set()

    def post(body: dict) -> tuple[int | None, object]:
        text = "\n".join(str(m.get("content", "")) for m in body.get("messages", []))
        marks = {k: re.search(p, text) for k, p in MARKS.items()}
        if marks["fail_once"] and text not in failed:
            failed.add(text)
            return int(marks["fail_once"].group(1)), None
        if marks["fail"]:
            return int(marks["fail"].group(1)), None
        score = int(marks["score"].group(1)) if marks["score"] else DEFAULT_SCORE
        said = "no JSON in here" if marks["garbage"] else json.dumps({"score": score, "reasoning": "marked"})
        return 200, {"choices": [{"message": {"role": "assistant", "content": said}}]}

    return post


def backoff_limit(attempt: Column) -> Column:
    """The longest wait before a retry; ``attempt`` counts from 1."""
    return F.least(F.lit(MAX_DELAY), F.lit(BASE_DELAY) * F.pow(F.lit(2.0), attempt - 1))


def score_marked(silver: DataFrame, prompt: Column | None = None) -> DataFrame:
    """Stand-in judge for tests and offline runs: the score marked in the text."""
    from ..functions.replies import marked_score

    text = rubric_prompt(F.col("conversation")) if prompt is None else prompt
    return silver.withColumns({"score": marked_score(text), "reasoning": F.lit("marked")})
