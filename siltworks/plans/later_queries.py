"""Contract queries of the later phases of the pipeline: registry transitions, media checks,
evaluators of other modalities, regression numbers, grants, training order, metrics of many runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import assets, grants, judge, order, registry, smoke
from ..sources import scratch, tiers, tracking
from . import pipeline
from .file_queries import OTHER_RUN, _silver_rows
from .queries import _FLAT, _SILVER, RUN, WHEN, flat_columns, query, table

# -- registry ----------------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Versions of seven adapters, and an event each as a request; many share an hour."""
    events = table(spark, sf_dir, "events")
    adapter, number = F.concat(F.lit("a"), (F.col("user_id") % 7).cast("string")), F.col("event_id") % 97
    version = F.concat(adapter, F.lit("-v"), number.cast("string"))
    versions = events.where(number < 90).select(
        adapter.alias("adapter_name"), version.alias("model_version"), F.lit("candidate").alias("status"), (number % 11 != 0).alias("weights"), F.lit(None).cast("string").alias("retired_at"),
    ).distinct()
    back = F.col("event_type") == "error"
    requests = events.select(
        adapter.alias("adapter_name"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"), F.col("event_id").alias("seq"),
        F.when(back, "rollback").otherwise("promote").alias("op"), F.when(~back, version).alias("model_version"), F.col("event_type").alias("by"),
    )
    return versions, requests


#: The same as a fold, request by request.
_FOLD = """ev AS (SELECT 'a' || user_id % 7 AS a, event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS tm, event_type = 'error' AS back, event_id % 97 AS m,
  CASE WHEN event_type <> 'error' THEN 'a' || user_id % 7 || '-v' || event_id % 97 END AS v, row_number() OVER (PARTITION BY user_id % 7 ORDER BY date_trunc('hour', ts), event_id) AS rn FROM events),
f AS (SELECT DISTINCT a, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::VARCHAR AS tm, NULL::BOOLEAN AS back, NULL::VARCHAR AS cur, NULL::VARCHAR AS ret, []::VARCHAR[] AS used, NULL::VARCHAR AS refused, NULL::VARCHAR AS up, NULL::VARCHAR AS down FROM ev
  UNION ALL SELECT a, rn, event_id, tm, back, CASE WHEN refused IS NULL THEN up ELSE cur END, CASE WHEN refused IS NULL THEN cur ELSE ret END,
    CASE WHEN refused IS NULL AND NOT back THEN list_append(used, up) ELSE used END, refused, CASE WHEN refused IS NULL THEN up END, CASE WHEN refused IS NULL THEN cur END
  FROM (SELECT e.a, e.rn, e.event_id, e.tm, e.back, f.cur, f.ret, f.used, CASE WHEN e.back THEN f.ret ELSE e.v END AS up,
    CASE WHEN e.back THEN CASE WHEN f.ret IS NULL THEN 'nothing to roll back to' END WHEN e.m >= 90 THEN 'unknown version' WHEN list_contains(f.used, e.v) THEN 'no candidate' WHEN e.m % 11 = 0 THEN 'missing weights' END AS refused
    FROM f JOIN ev e ON e.a = f.a AND e.rn = f.rn + 1))"""


@query(f"WITH RECURSIVE {_FOLD} SELECT event_id AS seq, refused, up AS gone_up, down AS gone_down FROM f WHERE rn > 0")
def registry_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotions and rollbacks in order: which are refused and why, what each promotes and retires."""
    return registry.judged(*_requests(spark, sf_dir)).select("seq", "refused", "gone_up", "gone_down")


@query(f"""WITH RECURSIVE {_FOLD}, s AS (SELECT up AS v, tm, event_id, CASE WHEN back THEN 'retired' ELSE 'candidate' END AS x, 'promoted' AS y, NULL::VARCHAR AS o FROM f WHERE up IS NOT NULL
  UNION ALL SELECT down, tm, event_id, 'promoted', 'retired', up FROM f WHERE down IS NOT NULL),
g AS (SELECT v, string_agg(tm || ' ' || x || '>' || y, ';' ORDER BY tm, event_id) AS h, last(y ORDER BY tm, event_id) AS y, last(o ORDER BY tm, event_id) AS o FROM s GROUP BY v)
SELECT k.v AS model_version, coalesce(y, 'candidate') AS status, o AS superseded_by, coalesce(h, '') AS history
FROM (SELECT DISTINCT 'a' || user_id % 7 || '-v' || event_id % 97 AS v FROM events WHERE event_id % 97 < 90) k LEFT JOIN g ON g.v = k.v""")
def registry_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions after all transitions, with their histories and what superseded them."""
    versions, requests = _requests(spark, sf_dir)
    found = registry.after(versions, scratch.table(registry.judged(versions, requests), "outcomes"))
    history = F.array_join(F.transform("history", lambda h: F.concat(h["at"], F.lit(" "), h["from"], F.lit(">"), h["to"])), ";")
    return found.select("model_version", "status", "superseded_by", history.alias("history"))


# -- media, modalities -------------------------------------------------------------


@query("""WITH k AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 1 ELSE page_id % 50 END AS k FROM pages)
SELECT page_id AS seq, CASE WHEN page_id % 11 = 0 THEN 'too_short' WHEN page_id % 5 <> 0 AND (k % 7 = 0 OR k % 3 = 2 OR k * 20 + 1 > 500) THEN 'bad_asset' END AS drop_reason FROM k""")
def bad_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose images are missing, of a kind that is not allowed, or too large; half of them share one image."""
    pages = table(spark, sf_dir, "pages")
    k = F.when(F.col("page_id") % 2 == 0, F.lit(1)).otherwise(F.col("page_id") % 50).cast("int")
    name = F.concat(F.lit("img-"), k.cast("string"), F.lit("."), F.element_at(F.array(*map(F.lit, ("png", "JPG", "exe"))), k % 3 + 1))
    root = scratch.path(spark, "assets")
    made = pages.where(k % 7 != 0).select(name.alias("name"), F.repeat(F.lit("x"), k * 20).alias("value")).distinct()
    made.write.partitionBy("name").option("lineSep", "\n").text(root)
    files = assets.listing(spark, root).groupBy(F.regexp_replace("uri", "/[^/]*$", "").alias("uri")).agg(F.sum("size").alias("size"))
    part = lambda kind, v: F.struct(F.lit(kind).alias("type"), v.alias("value"))
    image = F.when(F.col("page_id") % 5 != 0, F.array(part("image", F.concat(F.lit(f"{root}/name="), name)))).otherwise(F.array())
    turn = F.struct(F.concat(F.array(part("text", F.col("url"))), image).alias("content"), F.lit("user").alias("role"))
    rows = pages.select(F.col("page_id").alias("seq"), F.array(turn).alias("conversation"), F.when(F.col("page_id") % 11 == 0, "too_short").alias("drop_reason"))
    return assets.tested(rows, files, ("png", "jpg"), 500).select("seq", "drop_reason")


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records with scores of images, and of every third's audio twice."""
    rows = _silver_rows(spark, sf_dir).withColumns({"score": (F.col("seq") % 10 + 1).cast("int"), "reasoning": F.lit("why")})
    image = rows.where("seq % 4 != 1").select("id", F.lit("image").alias("modality"), (F.col("seq") % 7 / 10).alias("score"))
    audio = rows.where("seq % 3 = 0").select("id", F.lit("audio").alias("modality"), F.explode(F.array(F.col("seq") % 5 / 10, F.lit(0.4))).alias("score"))
    return judge.with_modality(rows, image.unionByName(audio), {"image": 0.2, "audio": 0.3})


_MODAL = f"""{_SILVER}, z AS (SELECT conv_id, CASE WHEN conv_id % 4 <> 1 THEN conv_id % 7 / 10.0::DOUBLE END AS image, CASE WHEN conv_id % 3 = 0 THEN least(conv_id % 5 / 10.0::DOUBLE, 0.4::DOUBLE) END AS audio FROM silver),
y AS (SELECT *, CASE WHEN image < 0.2 OR audio < 0.3 THEN 'vetoed' WHEN (conv_id % 10 + 1) / 10.0 < 0.7 THEN 'below_threshold' END AS drop_reason FROM z)"""


@query(f"WITH {_MODAL} SELECT conv_id AS seq, drop_reason, image, audio FROM y")
def modality_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluators of other modalities, merged per record, veto before the rubric decides."""
    at = lambda k: F.try_element_at("modality_scores", F.lit(k)).alias(k)
    return _evaluated(spark, sf_dir).select("seq", "drop_reason", at("image"), at("audio"))


@query(f"""WITH {_MODAL}, w AS (SELECT conv_id, 0 AS run, NULL::DOUBLE AS image, NULL::DOUBLE AS audio FROM y WHERE (conv_id % 10 + 1) / 10.0 >= 0.7
  UNION ALL SELECT conv_id, 1, image, audio FROM y WHERE drop_reason IS NULL)
SELECT row_number() OVER (ORDER BY run, conv_id) - 1 AS seq, run::INT AS run, (conv_id % 10 + 1) / 10.0::DOUBLE AS score, image, audio FROM w""")
def mixed_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers from before and after modality scores came, in one scan."""
    root = scratch.path(spark, "mixed")
    flagged = scratch.table(_evaluated(spark, sf_dir), "evaluated")
    plain = judge.promoted(flagged.drop("drop_reason", "normalized", "modality_scores"))
    for run, rows in ((RUN, judge.gold(plain, "judge", WHEN)), (OTHER_RUN, judge.gold_wide(flagged, "judge", WHEN))):
        dense = scratch.table(pipeline._dense(rows), "gold")
        tiers.write_tier(dense, root, "gold", run, "judge", "up", {}, (), dense.count(), 10)
    found = tiers.read_runs(spark, root, "gold", [RUN, OTHER_RUN])
    first = tiers.read_manifest(spark, root, "gold", RUN)["counts"]["written"]
    at = lambda k: F.try_element_at("evaluation.modality_scores", F.lit(k)).alias(k)
    return found.select("seq", (F.col("seq") >= first).cast("int").alias("run"), "evaluation.score", at("image"), at("audio"))


# -- regression, grants, order -----------------------------------------------------


_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower({x}), '[\x20\x09-\x0D]+'), lambda w: w <> ''))"


@query(f"""WITH {_FLAT}, w AS (SELECT d.source AS v, {_WORDS.format(x="q")} AS a, {_WORDS.format(x="a")} AS b FROM flat JOIN documents d USING (doc_id)),
m AS (SELECT v, count(*) AS n, floor(avg(CASE WHEN len(a) + len(b) > 0 THEN floor(2000 * len(list_intersect(a, b)) / (len(a) + len(b))) ELSE 1000 END))::BIGINT AS score FROM w GROUP BY v),
k AS (SELECT v, n, score, regexp_extract(v, '([0-9]+)$', 1)::INT AS k FROM m), c AS (SELECT *, CASE WHEN k % 2 = 0 THEN 'word' ELSE 'byte' END AS ad, k % 7 AS tm FROM k),
p AS (SELECT ad, v, k * 5 % 7 AS tm FROM c WHERE k % 3 = 0),
b AS (SELECT c.*, (SELECT max((p.tm, p.v)) FROM p WHERE p.ad = c.ad AND p.tm < c.tm) AS base FROM c)
SELECT b.v AS model_version, b.ad AS adapter_name, b.n, b.score, base[2] AS baseline, m.score AS baseline_score, b.score - m.score AS change FROM b LEFT JOIN m ON m.v = base[2]""")
def smoke_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version's outputs against its references, and against the last version promoted before it."""
    question, answer = flat_columns()
    docs = table(spark, sf_dir, "documents")
    samples = docs.select(F.col("source").alias("model_version"), answer.alias("tuned_output"), question.alias("reference"))
    k = F.regexp_extract("model_version", "([0-9]+)$", 1).cast("int")
    day = lambda n: F.concat(F.lit("2024-01-0"), (n + 1).cast("string"), F.lit("T00:00:00Z"))
    versions = samples.select("model_version").distinct().select("model_version", F.when(k % 2 == 0, "word").otherwise("byte").alias("adapter_name"), day(k % 7).alias("created_at"))
    promotions = versions.where(k % 3 == 0).select("adapter_name", day(k * 5 % 7).alias("at"), "model_version")
    return smoke.regression(samples, versions, promotions)


@query(r"""WITH u AS (SELECT page_id, split_part(split_part(regexp_replace(url, '^https?://', ''), '?', 1), '#', 1) AS path FROM pages), s AS (SELECT *, split_part(path, '/', 1) AS h, split_part(path, '/', 2) AS l FROM u),
r AS (SELECT page_id, CASE WHEN page_id % 17 <> 0 THEN 'p' || page_id % 4 END AS who, ['read', 'write', 'list'][page_id % 3 + 1] AS action, path, page_id % 5 <> 0 AS granted FROM s),
g AS (SELECT DISTINCT 'p' || length(h) % 4 AS who, h AS path, 'R' AS level FROM s UNION SELECT 'p' || length(h) % 4, h || '/' || l, CASE WHEN length(h) % 2 = 1 THEN 'W' ELSE '-' END FROM s
  UNION SELECT '*', h, 'R' FROM s WHERE page_id % 13 = 0 UNION SELECT 'p1', '', 'W'),
m AS (SELECT page_id, g.level, row_number() OVER (PARTITION BY page_id ORDER BY length(g.path) DESC, g.who = '*') AS n FROM r JOIN g ON (g.who = r.who OR g.who = '*') AND starts_with(r.path || '/', CASE g.path WHEN '' THEN '' ELSE g.path || '/' END)),
d AS (SELECT r.*, coalesce(level, '-') AS level FROM r LEFT JOIN (SELECT * FROM m WHERE n = 1) x USING (page_id)), a AS (SELECT *, level = 'W' AND action <> 'list' OR level = 'R' AND action = 'read' AS allowed FROM d)
SELECT page_id, level, allowed, granted <> allowed AS mismatch FROM a""")
def access_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests against the longest grant that fits, and answers that are not what the grants say."""
    pages = table(spark, sf_dir, "pages").withColumn("path", F.regexp_replace("url", r"^https?://|[?#].*$", ""))
    host, lang = F.split_part("path", F.lit("/"), F.lit(1)), F.split_part("path", F.lit("/"), F.lit(2))
    mine = F.concat(F.lit("p"), (F.length(host) % 4).cast("string"))
    own = lambda who, path, level: F.struct(who.alias("principal"), path.alias("path"), level.alias("level"))
    held = [own(mine, host, F.lit("R")), own(mine, F.concat_ws("/", host, lang), F.when(F.length(host) % 2 == 1, "W").otherwise("-")), F.when(F.col("page_id") % 13 == 0, own(F.lit("*"), host, F.lit("R"))), own(F.lit("p1"), F.lit(""), F.lit("W"))]
    given = pages.select(F.explode(F.array_compact(F.array(*held))).alias("g")).select("g.*").distinct()
    action = F.element_at(F.array(*map(F.lit, ("read", "write", "list"))), (F.col("page_id") % 3 + 1).cast("int"))
    requests = pages.select("page_id", F.when(F.col("page_id") % 17 != 0, F.concat(F.lit("p"), (F.col("page_id") % 4).cast("string"))).alias("principal"), action.alias("action"), "path", (F.col("page_id") % 5 != 0).alias("granted"))
    return grants.decided(requests, given).select("page_id", "level", "allowed", (F.col("granted") != F.col("allowed")).alias("mismatch"))


_SEED, _EPOCHS, _BATCH = 42, 3, 32
_KEYS = ", ".join(f"({e}, {i}, {k}::HUGEINT, {a}::BIGINT, {b}::BIGINT)" for e in range(_EPOCHS) for i, (k, a, b) in enumerate(order.keys(_SEED, e, 1 << 64)))


@query(f"""WITH RECURSIVE k AS (SELECT * FROM (VALUES {_KEYS}) t(epoch, i, k, a, b)), n AS (SELECT count(*) AS n FROM documents),
r AS (SELECT doc_id, epoch, 0 AS i, doc_id AS x FROM documents, (SELECT unnest(range({_EPOCHS}))::BIGINT AS epoch)
  UNION ALL SELECT doc_id, epoch, i + 1, CASE WHEN ((greatest(x, y) * a + b) % {order.PRIME} * ((greatest(x, y) * a + b) % {order.PRIME}) + b) % {order.PRIME} % 2 = 1 THEN y ELSE x END
  FROM (SELECT r.doc_id, r.epoch, r.i, r.x, k.a, k.b, (((k.k % n) - r.x + n) % n)::BIGINT AS y FROM r JOIN k ON k.epoch = r.epoch AND k.i = r.i, n))
SELECT doc_id, epoch, x // {_BATCH} AS step, x % {_BATCH} AS slot FROM r WHERE i = {order.ROUNDS}""")
def training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: each epoch's order of rows, as a step and a slot of every row."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return order.scheduled(docs, docs.count(), _EPOCHS, _BATCH, _SEED, "doc_id").select("doc_id", "epoch", "step", "slot")


@query("""SELECT user_id::VARCHAR AS run_id, event_type AS stage, count(*)::DOUBLE AS n, max(value) AS top, (user_id % 3)::VARCHAR AS kind FROM events WHERE event_type = 'purchase' AND user_id % 3 <> 1 GROUP BY user_id, event_type""")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of many runs and stages, recorded in one job and found by their tags; the later record counts."""
    root, run = scratch.path(spark, "metrics"), F.col("user_id").cast("string")
    kind = (F.col("user_id") % 3).cast("string")
    each = table(spark, sf_dir, "events").groupBy(run.alias("run_id"), F.col("event_type").alias("stage"), kind.alias("kind")).agg(F.count("*").cast("double").alias("n"), F.max("value").alias("top"))
    record = lambda n: each.select("run_id", "stage", F.create_map(F.lit("n"), n, F.lit("top"), F.col("top")).alias("metrics"), F.create_map(F.lit("kind"), F.col("kind")).alias("params"), F.create_map(F.lit("kind"), F.col("kind")).alias("tags"))
    tracking.log_many(record(F.lit(0.0)).where("stage = 'purchase'"), root)
    tracking.log_many(record(F.col("n")), root)
    found = tracking.search(spark, root, {"stage": "purchase"}).where(F.col("params").getItem("kind") != "1")
    return found.select("run_id", "stage", F.col("metrics").getItem("n").alias("n"), F.col("metrics").getItem("top").alias("top"), F.col("tags").getItem("kind").alias("kind"))
