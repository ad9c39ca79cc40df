"""Registry queries over manifest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources import scratch

SUMMARY = ("model_version", "adapter_name", "created_at", "status", "final_eval_loss")


def newest(manifests: DataFrame, status: str | None = None, adapter_name: str | None = None) -> DataFrame:
    """Valid manifests, newest first, ties by key; optional filters combine by AND."""
    rows = manifests.where("valid")
    if status is not None:
        rows = rows.where(F.col("status") == status)
    if adapter_name is not None:
        rows = rows.where(F.col("adapter_name") == adapter_name)
    return rows.orderBy(F.desc("created_at"), "key")


def summary(manifests: DataFrame) -> DataFrame:
    return manifests.select("model_version", "adapter_name", "created_at", "status", F.col("eval.final_eval_loss").alias("final_eval_loss"))


def invalid_keys(manifests: DataFrame) -> DataFrame:
    return manifests.where(~F.col("valid")).select("key").orderBy("key")


def lines(manifests: DataFrame) -> list[str]:
    """The listing as text: valid versions newest first, then invalid keys.  A registry is small."""
    rows = summary(newest(manifests)).collect()
    bad = invalid_keys(manifests).collect()
    if not rows and not bad:
        return ["no models registered"]
    widths = (45, 15, 22, 10, 0)
    head = ("MODEL_VERSION", "ADAPTER", "CREATED_AT", "STATUS", "FINAL_EVAL_LOSS")
    table = [head, *(tuple(str(v) for v in r) for r in rows)]
    return [" ".join(v.ljust(w) for v, w in zip(t, widths, strict=True)).rstrip() for t in table] + [f"{r['key']:<45} INVALID" for r in bad]


def _initial(versions: DataFrame) -> DataFrame:
    """The transitions that would lead to the versions' states: what was last retired, then what is promoted."""
    standing = versions.where("status = 'promoted'").select("adapter_name", "model_version", F.lit(2).alias("_first"))
    retired = versions.where("status = 'retired'").groupBy("adapter_name").agg(F.max_by("model_version", F.struct("retired_at", "model_version")).alias("model_version"))
    retired = retired.join(standing.select("adapter_name"), "adapter_name", "left_semi").withColumn("_first", F.lit(1))
    return standing.unionByName(retired)


def judged(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests with ``refused`` (null: done), ``gone_up`` and ``gone_down``: the versions that a request promotes and retires.

    ``versions`` has (model_version, adapter_name, status, weights, retired_at), ``requests``
    (adapter_name, at, seq, op, model_version, by) with op promote or rollback, in the order of at and seq.
    A candidate whose weights are there is promoted; what was promoted before it is retired.  A rollback
    promotes the version retired last and retires the one that stands, if there are two.

    No state is carried along: a promotion is done when it is its version's first good one, and the
    version that stands before the k-th promotion is the last one that an even number of rollbacks
    followed.  So all comes from running counts and last values over an adapter's requests.
    """
    known = versions.select("adapter_name", "model_version", F.col("status").alias("_status"), F.col("weights").alias("_weights"))
    told = requests.join(known, ["adapter_name", "model_version"], "left").withColumn("_first", F.lit(9))
    up = F.col("op") == "promote"
    good = up & (F.col("_status") == "candidate") & F.col("_weights")
    again = Window.partitionBy("adapter_name", "model_version", good).orderBy("at", "seq")
    told = told.withColumn("_nth", F.when(good, F.row_number().over(again)))
    reason = (
        F.when(up & F.col("_status").isNull(), "unknown version").when(up & ((F.col("_status") != "candidate") | (F.col("_nth") > 1)), "no candidate")
        .when(up & ~F.col("_weights"), "missing weights").when(~up & (F.col("op") != "rollback"), "unknown operation")
    )
    told = told.withColumn("refused", reason).drop("_status", "_weights", "_nth")
    before = _initial(versions)
    blank = [F.lit(None).cast(told.schema[c].dataType).alias(c) for c in told.columns if c not in ("adapter_name", "model_version", "_first", "op")]
    rows = scratch.table(told.unionByName(before.select("adapter_name", "model_version", "_first", F.lit("promote").alias("op"), *blank)), "transitions")
    order = ["_first", "at", "seq"]
    by = Window.partitionBy("adapter_name").orderBy(*order)
    done, back = (F.col("op") == "promote") & F.col("refused").isNull(), F.col("op") == "rollback"
    rows = rows.withColumn("_k", F.sum(F.when(done, 1).otherwise(0)).over(by))
    rows = rows.withColumn("refused", F.when(back & (F.col("_k") < 2), "nothing to roll back to").otherwise(F.col("refused")))
    turned = back & F.col("refused").isNull()
    gap = Window.partitionBy("adapter_name", "_k")
    rows = rows.withColumns({"_m": F.sum(F.when(turned, 1).otherwise(0)).over(gap), "_i": F.sum(F.when(turned, 1).otherwise(0)).over(gap.orderBy(*order))})
    kept = F.when(done & (F.col("_m") % 2 == 0), F.col("model_version"))
    rows = rows.withColumn("_stood", F.when(done, F.last(kept, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))))
    newest = F.last(F.when(done, F.col("model_version")), ignorenulls=True).over(by)
    other = F.last(F.when(done, F.struct(F.col("_stood").alias("v"))), ignorenulls=True).over(by)["v"]
    rows = rows.withColumns({"_new": newest, "_old": other})
    odd = F.col("_i") % 2 == 1
    goes_up = F.when(done, F.col("model_version")).when(turned, F.when(odd, F.col("_old")).otherwise(F.col("_new")))
    goes_down = F.when(done, F.col("_stood")).when(turned, F.when(odd, F.col("_new")).otherwise(F.col("_old")))
    return rows.withColumns({"gone_up": goes_up, "gone_down": goes_down}).where("_first = 9").drop("_first", "_k", "_m", "_i", "_stood", "_new", "_old")


HISTORY = "array<struct<at:string,`from`:string,`to`:string,by:string>>"


def after(versions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(model_version, adapter_name, status, superseded_by, history): the versions after the
    requests, with the transitions of each in order."""
    step = lambda v, start, end, other: F.struct(v.alias("v"), F.lit(start).alias("start"), F.lit(end).alias("end"), other.alias("other"))
    promoted = F.struct(F.col("gone_up").alias("v"), F.when(F.col("op") == "promote", "candidate").otherwise("retired").alias("start"), F.lit("promoted").alias("end"), F.lit(None).cast("string").alias("other"))
    steps = outcomes.where("refused is null").select("adapter_name", "at", "seq", "by", F.explode(F.array(promoted, step(F.col("gone_down"), "promoted", "retired", F.col("gone_up")))).alias("s")).where("s.v is not null")
    entry = F.struct("at", "seq", F.struct(F.col("at").cast("string").alias("at"), F.col("s.start").alias("from"), F.col("s.end").alias("to"), "by").alias("h"), F.col("s.other").alias("other"))
    each = steps.groupBy("adapter_name", F.col("s.v").alias("model_version")).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    last = F.get("e", F.size("e") - 1)
    own = each.select("adapter_name", "model_version", last["h"]["to"].alias("_status"), last["other"].alias("_by"), F.transform("e", lambda x: x["h"]).cast(HISTORY).alias("_history"))
    joined = versions.join(own, ["adapter_name", "model_version"], "left")
    former = F.col("superseded_by") if "superseded_by" in versions.columns else F.lit(None).cast("string")
    past = F.coalesce(F.col("history"), F.array().cast(HISTORY)) if "history" in versions.columns else F.array().cast(HISTORY)
    changed: Column = F.col("_status").isNotNull()
    return joined.select(
        "model_version", "adapter_name", F.coalesce("_status", "status").alias("status"), F.when(changed, F.col("_by")).otherwise(former).alias("superseded_by"),
        F.concat(past, F.coalesce("_history", F.array().cast(HISTORY))).alias("history"),
    )


def promote(manifests: DataFrame, model_version: str) -> DataFrame:
    """The rows' states alone after one promotion; the version promoted so far is retired, so one stays promoted."""
    chosen = F.col("model_version") == model_version
    return manifests.withColumn("status", F.when(chosen, "promoted").when(F.col("status") == "promoted", "retired").otherwise(F.col("status")))


def named(runs: DataFrame, root: str) -> DataFrame:
    """Add what a registered version derives from (run_id, adapter_name): model_version, gold_manifest_uri, index_map_uri, status."""
    base, run = root.rstrip("/"), F.col("run_id")
    return runs.withColumns({
        "model_version": F.concat_ws("-", "adapter_name", "run_id"), "gold_manifest_uri": F.concat(F.lit(f"{base}/gold/"), run, F.lit("/manifest.json")),
        "index_map_uri": F.concat(F.lit(f"{base}/artifacts/"), run, F.lit("/index_map.json")), "status": F.lit("candidate"),
    })


def lookup(asked: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add ``found`` to versions: whether a valid manifest has that name; one that is registered twice is one."""
    names = manifests.where("valid").select(F.col("model_version").alias("_name")).distinct()
    return asked.join(names, F.col("model_version") == F.col("_name"), "left").withColumn("found", F.col("_name").isNotNull()).drop("_name")
