"""Contract queries over files: sources, tiers, manifests, registry, tensors, records of runs.

The driver's tables are written to the scratch folder in a format of the
library's, read back by its operators, and compared with SQL over the tables.
Identifiers in docstrings are those of the operator inventory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import config as cfg, schemas
from ..functions import conversation as conv, hashing, replies
from ..operators import clean, ingest, judge, lineage, registry, smoke, tokenize
from ..sources import files, readers, registry as registry_files, scratch, sql_source, tensors, tiers, tracking
from . import pipeline
from .queries import _FLAT, _INDEXED, _MANIFESTS, _RAW, _SCORED, _SILVER, DOCS_URI, RUN, WHEN, _indexed, _manifests, bronze, flat_columns, query, raw_rows, scored, silver_turns, table

OTHER_RUN = "run-20240102-000000-abcdef"


def _one_file(df: DataFrame, name: str, kind: str) -> str:
    """Write a sorted frame as a single CSV or text file; its path."""
    folder = scratch.path(df.sparkSession, name)
    out = df.coalesce(1).write
    if kind == "csv":
        out.csv(folder, header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    else:
        out.option("lineSep", "\n").text(folder)
    return next(f"{folder}/{n}" for n in files.listing(df.sparkSession, folder) if n.startswith("part-"))


def _json(*columns: str):
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- sources -----------------------------------------------------------------------


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, coalesce(text, '') AS text, true AS fine FROM documents")
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes and line feeds through one CSV file, read block by block."""
    docs = table(spark, sf_dir, "documents").orderBy("doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = readers.read(spark, readers.Source("csv", _one_file(docs, "csv", "csv"), readers.Mapping("doc_id", "text")))
    fields = rows.withColumn("f", F.from_json("raw", "doc_id string, text string"))
    return fields.select(F.col("f.doc_id").cast("long").alias("doc_id"), "n", F.col("f.text").alias("text"), F.col("error").isNull().alias("fine"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, text FROM documents")
def scan_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with their numbers."""
    path = _one_file(table(spark, sf_dir, "documents").orderBy("doc_id").select(_json("doc_id", "text")), "jsonl", "text")
    rows = readers.read(spark, readers.Source("jsonl", path)).withColumn("f", F.from_json("raw", "doc_id long, text string"))
    return rows.select("f.doc_id", "n", "f.text")


@query("SELECT (n_nationkey + 1)::BIGINT AS n, n_nationkey % 7 = 3 AS broken, n_nationkey = (SELECT min(n_nationkey) FROM nation WHERE n_nationkey % 7 = 3) AS first FROM nation")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: lines that are no objects, and the one that aborts an ingestion."""
    good = F.to_json(F.struct("n_nationkey", "n_name"))
    lines = table(spark, sf_dir, "nation").orderBy("n_nationkey").select(F.when(F.col("n_nationkey") % 7 == 3, F.concat(good, F.lit("]"))).otherwise(good).alias("value"))
    rows = readers.read(spark, readers.Source("jsonl", _one_file(lines, "broken", "text")))
    first = int((readers.first_error(rows) or "record 0:").split()[1].rstrip(":"))
    return rows.select("n", F.col("error").isNotNull().alias("broken"), (F.col("n") == first).alias("first"))


@query("""SELECT name, name IN (SELECT r_name FROM region) AS ok FROM (SELECT n_name AS name FROM nation WHERE n_nationkey < 4 UNION ALL SELECT r_name FROM region)""")
def csv_header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped columns must be in the header."""
    regions = [r[0] for r in table(spark, sf_dir, "region").select("r_name").collect()]  # five rows
    others = [r[0] for r in table(spark, sf_dir, "nation").where("n_nationkey < 4").select("n_name").collect()]
    path = _one_file(spark.range(1).select(*[F.lit("x").alias(r) for r in regions]), "header", "csv")

    def ok(name: str) -> bool:
        try:
            readers.check_mapping(spark, readers.Source("csv", path, readers.Mapping(name)))
        except readers.SourceError:
            return False
        return True

    return spark.createDataFrame([(n, ok(n)) for n in others + regions], "name string, ok boolean")


@query("""WITH t AS (SELECT source, count(*) AS n, ['csv', 'jsonl', 'sql', 'pdf', 'api', 'xml'][regexp_extract(source, '([0-9]+)$', 1)::INT % 6 + 1] AS type FROM documents GROUP BY source)
SELECT source, type, n, type IN ('csv', 'jsonl', 'sql') AS known, type <> 'xml' AS reserved FROM t""")
def source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by type, and which types have a reader or are reserved for one."""
    kinds = F.array(*map(F.lit, (*schemas.SOURCE_TYPES, "xml")))
    kind = F.element_at(kinds, F.regexp_extract("source", "([0-9]+)$", 1).cast("int") % 6 + 1)
    found = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).withColumn("type", kind)
    return found.select("source", "type", "n", readers.known(F.col("type")).alias("known"), F.col("type").isin(*schemas.SOURCE_TYPES).alias("reserved"))


@query("""SELECT place AS _offset, c_custkey, c_name, c_acctbal FROM (SELECT *, row_number() OVER (ORDER BY c_nationkey, c_custkey, c_name, c_acctbal) - 1 AS place FROM customer) WHERE c_acctbal >= 100 AND c_nationkey <> 7""")
def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4, the sql source: a database's rows in several partitions, with places and pushed filters."""
    held = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    dsn = sql_source.export(held, scratch.path(spark, "customers.db"), "customer")
    found = sql_source.rows(spark, dsn, "SELECT c_nationkey, c_custkey, c_name, c_acctbal FROM customer", "c_nationkey", 500, pushed=True)
    return found.where("c_acctbal >= 100 AND c_nationkey <> 7").select("_offset", "c_custkey", "c_name", "c_acctbal")


@query("""WITH s AS (SELECT 0 AS i, 'csv' AS type, 'row:' AS p, row_number() OVER (ORDER BY c_custkey) AS n FROM customer
UNION ALL SELECT 1, 'jsonl', 'line:', row_number() OVER (ORDER BY s_suppkey) FROM supplier)
SELECT type, p || n AS locator, row_number() OVER (ORDER BY i, n) - 1 AS seq FROM s""")
def ingest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources one after the other, in the order of the configuration."""
    rows = table(spark, sf_dir, "customer").orderBy("c_custkey").select("c_custkey", "c_name")
    lines = table(spark, sf_dir, "supplier").orderBy("s_suppkey").select(_json("s_suppkey", "s_name"))
    sources = [readers.Source("csv", _one_file(rows, "customer", "csv")), readers.Source("jsonl", _one_file(lines, "supplier", "text"))]
    frames = [ingest.envelope(readers.read(spark, s), RUN, F.lit(s.uri), s.type, WHEN, i) for i, s in enumerate(sources)]
    return pipeline._dense(_union(frames)).select("source.type", "source.locator", "seq")


@query(f"""WITH {_FLAT}, k AS (SELECT doc_id, q, a, regexp_extract(source, '([0-9]+)$', 1)::INT % 2 = 0 AS even FROM flat JOIN documents USING (doc_id))
SELECT doc_id AS seq, even AND q <> '' AND a <> '' AS mappable, CASE WHEN even AND q <> '' AND a <> '' THEN q END AS prompt FROM k""")
def csv_mapping_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of CSV sources by their source's mapping; of repeated sources the last counts."""
    names = [r[0] for r in table(spark, sf_dir, "documents").select("source").distinct().collect()]  # the sources
    right = {"prompt_column": "question", "response_column": "answer"}
    listed = [{"type": "csv", "uri": n, "mapping": {"prompt_column": "none", "response_column": "answer"}} for n in names]
    listed += [{"type": "csv", "uri": n} | ({"mapping": right} if int(n[3:]) % 2 == 0 else {}) for n in names]
    mappings = pipeline.mappings(spark, cfg.parse({"model": {"adapter": "word"}, "ingest": {"sources": listed}}))
    uris = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"))
    raw = raw_rows(spark, sf_dir).join(uris, F.col("doc_id") == F.col("_id")).select("n", "raw", "_source")
    mapped = clean.map_records(ingest.envelope(raw, RUN, F.col("_source"), "csv", WHEN), mappings)
    return mapped.select("seq", "mappable", F.get("conversation", 0)["content"][0]["value"].alias("prompt"))


# -- tiers -------------------------------------------------------------------------


def _bronze_tier(spark: SparkSession, sf_dir: str, shard_rows: int = 300) -> tuple[str, dict]:
    root = scratch.path(spark, "tiers")
    rows = pipeline._dense(bronze(spark, sf_dir))
    total = table(spark, sf_dir, "documents").count()
    return root, tiers.write_tier(rows, root, "bronze", RUN, "ingest", None, {}, (), total, shard_rows)


@query(f"""WITH {_FLAT} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS seq, 'line:' || (doc_id + 1) AS locator, 'sha256:' || sha256({_RAW}) AS content_hash, {_RAW} AS raw FROM flat""")
def tier_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tier of many shards, written and read in file and line order."""
    root, _ = _bronze_tier(spark, sf_dir)
    return tiers.read_tier(spark, root, "bronze", RUN).select("seq", "source.locator", "content_hash", "raw")


@query("""SELECT 'bronze' AS tier, 'ingest' AS stage, ceil(count(*) / 300.0)::BIGINT AS n_files, count(*) AS read, count(*) AS written, 0::BIGINT AS dropped, true AS hashed FROM documents""")
def tier_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, A1: the manifest that commits a tier."""
    root, _ = _bronze_tier(spark, sf_dir)
    m = tiers.read_manifest(spark, root, "bronze", RUN)
    row = (m["tier"], m["producer"]["stage"], len(m["files"]), *(m["counts"][k] for k in ("read", "written", "dropped")), m["records_hash"])
    made = spark.createDataFrame([row], "tier string, stage string, n_files long, read long, written long, dropped long, h string")
    return made.withColumn("hashed", schemas.is_hash(F.col("h"))).drop("h")


@query("""SELECT 'sha256:' || sha256(string_agg(to_json({'n_name': n_name, 'n_nationkey': n_nationkey})::VARCHAR || chr(10), '' ORDER BY n_nationkey)) AS records_hash FROM nation""")
def tier_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash of a shard's bytes."""
    rows = table(spark, sf_dir, "nation").select("n_name", "n_nationkey", F.col("n_nationkey").cast("long").alias("seq"))
    target = f"{scratch.path(spark, 'hashed')}/tier"
    names = tiers.write_shards(rows, target, rows.count(), None)
    return spark.createDataFrame([(tiers.records_hash(spark, [f"{target}/{n}" for n in names]),)], "records_hash string")


@query("""SELECT 'first' AS run, n_nationkey, 3 AS n_files FROM nation WHERE n_nationkey < 12 UNION ALL SELECT 'second', n_nationkey, 7 FROM nation""")
def tier_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: a run replaces its own output and no other run's."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").cast("long").alias("seq"))
    root = scratch.path(spark, "overwritten")
    tiers.write_shards(rows, f"{root}/first", 25, 2)
    tiers.write_shards(rows, f"{root}/second", 25, 4)
    tiers.write_shards(rows.where("n_nationkey < 12"), f"{root}/first", 12, 4)
    read = lambda run: spark.read.text(f"{root}/{run}").select(F.lit(run).alias("run"), F.get_json_object("value", "$.n_nationkey").cast("int").alias("n_nationkey"), F.lit(len(files.listing(spark, f"{root}/{run}"))).alias("n_files"))
    return read("first").union(read("second"))


@query("SELECT * FROM (VALUES ('bronze', true), ('silver', false), ('gold', false)) t(tier, complete)")
def upstream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tier without a manifest is not read."""
    root, _ = _bronze_tier(spark, sf_dir)
    files.write_bytes(spark, f"{tiers.folder(root, 'silver', RUN)}/records-00000.jsonl", b"{}\n")

    def complete(tier: str) -> bool:
        try:
            tiers.read_tier(spark, root, tier, RUN)
        except tiers.UpstreamIncomplete:
            return False
        return True

    return spark.createDataFrame([(t, complete(t)) for t in schemas.TIERS], "tier string, complete boolean")


def _some_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("seq") % 89
    broken = {"id": F.when(k == 13, F.lit("no id")).otherwise(F.col("id")), "content_hash": F.when(k == 29, F.lit("sha256:0")).otherwise(F.col("content_hash")), "raw": F.when(k == 71, F.lit(None)).otherwise(F.col("raw"))}
    return bronze(spark, sf_dir).withColumns(broken)


@query("SELECT doc_id AS seq, doc_id % 89 NOT IN (13, 29, 71) AS valid FROM documents")
def bronze_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw records against their schema."""
    return _some_broken(spark, sf_dir).select("seq", schemas.bronze_valid().alias("valid"))


@query("SELECT min(doc_id) AS seq FROM documents WHERE doc_id % 89 IN (13, 29, 71)")
def first_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record that a stage aborts at."""
    return tiers.first_invalid(_some_broken(spark, sf_dir), schemas.bronze_valid()).select("seq")


def _silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = silver_turns(spark, sf_dir).withColumns({"id": hashing.record_id(F.lit(RUN), F.col("conv_id").cast("string")), "run_id": F.lit(RUN), "content_hash": hashing.hash_struct(F.col("conversation"))})
    return clean.silver(flagged)


@query(f"WITH {_SILVER} SELECT conv_id AS seq, conv_id % 13 BETWEEN 1 AND 10 AS valid FROM silver")
def gold_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """promoted records against their schema; a score is there and at most 1."""
    k = F.col("seq") % 13
    value = F.struct((k / 10).alias("score"), F.lit("m").alias("judge_model"), F.lit("r").alias("reasoning"), F.lit(WHEN).alias("evaluated_at"))
    return _silver_rows(spark, sf_dir).withColumn("evaluation", F.when(k > 0, value)).select("seq", schemas.gold_valid().alias("valid"))


@query(f"""WITH {_FLAT}, e AS (SELECT doc_id, q, a, {_RAW} AS raw FROM flat) SELECT doc_id AS seq, 'sha256:' || sha256(raw) AS bronze_content_hash, '0.1.0' AS cleaner_version, 2::BIGINT AS n_turns, true AS unscored
FROM e WHERE q <> '' AND a <> ''""")
def silver_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of a raw record goes to the next tier."""
    none = spark.createDataFrame([], "uri string, prompt_column string, response_column string, system_column string")
    mapped = clean.map_records(bronze(spark, sf_dir), none).where("mappable").withColumn("drop_reason", F.lit(None).cast("string"))
    return clean.silver(mapped).select("seq", "lineage.*", F.size("conversation").cast("long").alias("n_turns"), F.col("evaluation").isNull().alias("unscored"))


@query(f"WITH {_SILVER} SELECT conv_id AS seq, (conv_id % 10 + 1) / 10.0::DOUBLE AS score, 'judge' AS judge_model, 'why' AS reasoning, '{WHEN}' AS evaluated_at FROM silver WHERE conv_id % 10 >= 6")
def gold_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promoted records with their evaluation."""
    marked = _silver_rows(spark, sf_dir).withColumns({"score": (F.col("seq") % 10 + 1).cast("int"), "reasoning": F.lit("why")})
    return judge.gold(judge.promoted(marked), "judge", WHEN).select("seq", "evaluation.*")


@query("""WITH r AS (SELECT user_id, CASE WHEN event_type <> 'view' THEN CASE WHEN event_id % 149 = 0 THEN 'odd' WHEN event_id % 151 = 0 THEN 'judge_error'
  ELSE ['unmappable', 'bad_structure', 'empty_turn', 'too_short', 'too_long', 'duplicate'][event_id % 6 + 1] END END AS reason FROM events)
SELECT user_id AS run, count(*) AS read, count(*) FILTER (reason IS NULL) AS written, count(reason) AS dropped,
  coalesce(string_agg(DISTINCT reason, ',' ORDER BY reason) FILTER (reason IN ('odd', 'judge_error')), '') AS unknown, count(*) FILTER (reason IN ('odd', 'judge_error')) = 0 AS valid FROM r GROUP BY user_id""")
def drop_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of many runs at once, and the drop reasons that their stage does not know."""
    k = F.col("event_id")
    reason = F.when(k % 149 == 0, "odd").when(k % 151 == 0, "judge_error").otherwise(F.element_at(F.array(*map(F.lit, schemas.CLEAN_REASONS)), (k % 6 + 1).cast("int")))
    rows = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "view", reason).alias("reason"))
    return lineage.audited(rows, "user_id", "reason", schemas.CLEAN_REASONS).withColumn("unknown", F.array_join("unknown", ","))


@query(r"""SELECT o_orderkey, regexp_full_match('run-' || strftime(o_orderdate, '%Y%m%d') || '-000000-' || printf('%06x', o_orderkey * 7), 'run-[0-9]{8}-[0-9]{6}-[0-9a-f]{6}') AS valid FROM orders""")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the form of run identifiers; long keys break it."""
    made = F.concat(F.lit("run-"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-000000-"), F.lower(F.lpad(F.hex(F.col("o_orderkey") * 7), 6, "0")))
    made = F.when(F.col("o_orderkey") * 7 >= 1 << 24, F.concat(made, F.lit("0"))).otherwise(made)
    return table(spark, sf_dir, "orders").select("o_orderkey", schemas.is_run_id(made).alias("valid"))


@query("""SELECT event_id, 'run-' || strftime(ts, '%Y%m%d-%H%M%S') || '-' || sha256(event_id::VARCHAR)[1:6] AS run_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS now, true AS valid FROM events""")
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run identifiers and times of events, in their forms."""
    made = table(spark, sf_dir, "events").select("event_id", hashing.run_id(F.col("ts"), F.col("event_id")).alias("run_id"), hashing.utc(F.col("ts")).alias("now"))
    return made.withColumn("valid", schemas.is_run_id(F.col("run_id")) & schemas.is_utc(F.col("now")))


# -- single files ------------------------------------------------------------------


@query("SELECT r_name AS name, r_regionkey::BIGINT AS key, length(r_name)::BIGINT AS size, true AS listed, true AS absent FROM region")
def point_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON and byte files one by one, and the listing of their folder."""
    folder, rows = scratch.path(spark, "points"), []
    found = table(spark, sf_dir, "region").select("r_name", "r_regionkey").collect()  # five rows
    for name, key in found:
        files.write_json(spark, f"{folder}/{name}.json", {"name": name, "key": key})
        files.write_bytes(spark, f"{folder}/{name}.bin", name.encode())
    names = files.listing(spark, folder)
    ordered = names == sorted(f"{name}.{kind}" for name, _ in found for kind in ("bin", "json"))
    for name, _ in found:
        record = files.read_json(spark, f"{folder}/{name}.json")
        rows.append((record["name"], record["key"], len(files.read_bytes(spark, f"{folder}/{name}.bin")), ordered, files.read_bytes(spark, f"{folder}/{name}.none") is None))
    return spark.createDataFrame(rows, "name string, key long, size long, listed boolean, absent boolean")


@query("SELECT 'r' || r_regionkey || '/' || r_name AS path, length(r_name)::BIGINT AS size FROM region")
def tree_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder mirrored with its subfolders."""
    source, target = scratch.path(spark, "tree"), scratch.path(spark, "mirror")
    for name, key in table(spark, sf_dir, "region").select("r_name", "r_regionkey").collect():
        files.write_bytes(spark, f"{source}/r{key}/{name}", name.encode())
    files.copy_tree(spark, source, target)
    rows = [(f"{d}/{n}", len(files.read_bytes(spark, f"{target}/{d}/{n}"))) for d in files.listing(spark, target) for n in files.listing(spark, f"{target}/{d}")]
    return spark.createDataFrame(rows, "path string, size long")


# -- registry, runs ----------------------------------------------------------------


def _registry(spark: SparkSession, sf_dir: str) -> str:
    """Manifest files of all sources; every fifth is broken in one of five ways."""
    root = scratch.path(spark, "registry")
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).collect()  # the sources
    for name, n in rows:
        k = int(name[3:])
        manifest = {
            "model_version": name, "run_id": RUN, "adapter_name": "word" if k % 2 == 0 else "byte", "base_model": "b", "method": "full", "created_at": f"2024-01-{k % 7 + 1:02d}T00:00:00Z",
            "gold_manifest_uri": "g", "index_map_uri": "i", "weights_uri": "w", "mlflow_run_id": "t", "hyperparameters": {}, "eval": {"final_train_loss": float(n), "final_eval_loss": 0.5}, "status": "candidate",
        }
        if k % 5 != 4:
            registry_files.put(spark, root, manifest)
            continue
        broken = [b"no json", b'{"a": "\xff"}', b"[1]"]
        files.write_bytes(spark, f"{root}/{name}/manifest.json", broken[k % 3])
    return root


@query("""SELECT source || '/manifest.json' AS key, k % 5 <> 4 AS valid, CASE WHEN k % 5 <> 4 THEN n::DOUBLE END AS loss
FROM (SELECT source, count(*) AS n, regexp_extract(source, '([0-9]+)$', 1)::INT AS k FROM documents GROUP BY source)""")
def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All manifests below a folder, broken ones included."""
    found = registry_files.scan(spark, _registry(spark, sf_dir))
    return found.select("key", "valid", F.when(F.col("valid"), F.col("eval.final_train_loss")).alias("loss"))


@query("""SELECT source AS model_version, k % 5 <> 4 AS found FROM (SELECT DISTINCT source, regexp_extract(source, '([0-9]+)$', 1)::INT AS k FROM documents)""")
def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions joined with the manifests that are there and valid."""
    asked = table(spark, sf_dir, "documents").select(F.col("source").alias("model_version")).distinct()
    return registry.lookup(asked, registry_files.scan(spark, _registry(spark, sf_dir))).select("model_version", "found")


@query(f"""WITH {_MANIFESTS}, v AS (SELECT row_number() OVER (ORDER BY created_at DESC, key) AS n, rtrim(rpad(model_version, 45, ' ') || ' ' || rpad(adapter_name, 15, ' ') || ' ' || rpad(created_at, 22, ' ') || ' ' || rpad(status, 10, ' ') || ' ' || final_eval_loss::VARCHAR) AS line FROM m WHERE valid),
x AS (SELECT (SELECT count(*) FROM v) + row_number() OVER (ORDER BY key) AS n, rpad(key, 45, ' ') || ' INVALID' AS line FROM m WHERE NOT valid)
SELECT 0::BIGINT AS n, rpad('MODEL_VERSION', 45, ' ') || ' ' || rpad('ADAPTER', 15, ' ') || ' ' || rpad('CREATED_AT', 22, ' ') || ' ' || rpad('STATUS', 10, ' ') || ' FINAL_EVAL_LOSS' AS line UNION ALL FROM v UNION ALL FROM x""")
def registry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing as text."""
    return spark.createDataFrame(list(enumerate(registry.lines(_manifests(spark, sf_dir)))), "n long, line string")


@query("""SELECT source AS run_id, 'judge' AS stage, count(*)::DOUBLE AS n, source || '.txt' AS artifact, regexp_extract(source, '([0-9]+)$', 1)::INT % 2 = 0 AS even FROM documents GROUP BY source""")
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics, parameters, tags and artifacts of runs, found by tags."""
    root = scratch.path(spark, "runs")
    rows = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).collect()  # the sources
    for name, n in rows:
        for stage in ("judge", "train"):
            tracking.log(spark, root, name, stage, {"n": float(n)}, {"k": int(name[3:])}, {"even": str(int(name[3:]) % 2 == 0)}, {f"{name}.txt": name.encode()})
    tracking.one(spark, root, rows[0][0], "train")
    found = tracking.search(spark, root, {"stage": "judge"})
    return found.select("run_id", "stage", F.col("metrics").getItem("n").alias("n"), F.get("artifacts", 0).alias("artifact"), (F.col("tags").getItem("even") == "True").alias("even"))


# -- judging -----------------------------------------------------------------------

_OUTCOMES = ["", " [[score=3]]", " [[fail=500]]", " [[fail_once=503]] [[score=4]]", " [[garbage]]", " [[fail_once=404]]", " [[fail=400]] [[score=9]]", " [[score=11]]"]


@query(f"WITH {_SILVER} SELECT conv_id, CASE conv_id % 8 WHEN 0 THEN 8 WHEN 1 THEN 3 WHEN 3 THEN 4 END AS score FROM silver")
def scored_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An endpoint's replies joined by place, with failures of many kinds."""
    marks = F.array(*[F.lit(m) for m in _OUTCOMES])
    said = lambda t: F.struct(F.transform(t["content"], lambda p: F.struct(p["type"].alias("type"), F.concat(p["value"], F.get(marks, (F.col("conv_id") % 8).cast("int"))).alias("value"))).alias("content"), t["role"].alias("role"))
    marked = silver_turns(spark, sf_dir).withColumn("conversation", F.transform("conversation", said)).withColumn("seq", F.col("conv_id"))
    # the numbers of the mark that counts are the same in all turns
    found = judge.score_replies(marked, judge.stand_in, "judge", 4, 2, 2, sleep=lambda seconds: None)
    return found.select("conv_id", "score")


@query("""SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN 8 WHEN 1 THEN 3 WHEN 3 THEN 4 END AS score FROM conversations""")
def marked_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in judge as an expression, retries included."""
    marked = F.concat("text", F.get(F.array(*[F.lit(m) for m in _OUTCOMES]), (F.col("turn") % 8).cast("int")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", replies.marked_score(marked).alias("score"))


@query("SELECT n_nationkey AS attempt, least(60.0::DOUBLE, 2.0 * pow(2, n_nationkey - 1)) AS seconds FROM nation WHERE n_nationkey > 0")
def backoff_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest wait before each retry."""
    return table(spark, sf_dir, "nation").where("n_nationkey > 0").select(F.col("n_nationkey").alias("attempt"), judge.backoff_limit(F.col("n_nationkey")).alias("seconds"))


@query(f"WITH {_SCORED} SELECT doc_id, CASE WHEN normalized IS NOT NULL THEN least(floor(normalized * 10)::INT, 9) END AS bin FROM p")
def score_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each score's bin."""
    return scored(spark, sf_dir).select("doc_id", judge.bin_of(F.col("normalized")).alias("bin"))


# -- tokens, tensors, samples ------------------------------------------------------


@query(f"""WITH {_SILVER} SELECT conv_id, CASE WHEN conv_id % 3 = 1 THEN 'unsupported_modality' WHEN c[1].r = 'assistant' THEN 'masking_mismatch' END AS drop_reason FROM silver""")
def other_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records with parts that are no text never reach the tokenizer."""
    image = F.array(F.struct(F.array(F.struct(F.lit("image").alias("type"), F.lit("x.png").alias("value"))).alias("content"), F.lit("user").alias("role")))
    c = F.col("conversation")
    rows = silver_turns(spark, sf_dir).select("conv_id", F.when(F.col("conv_id") % 3 == 1, F.concat(image, c)).otherwise(c).alias("conversation"))
    return tokenize.tokenized(rows).select("conv_id", "drop_reason")


@query("SELECT conv_id, turn, coalesce(role, '') AS role, text || chr(10) || chr(10) || 'part two' AS content FROM conversations")
def joined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text parts of a turn joined by a blank line."""
    part = lambda v: F.struct(F.lit("text").alias("type"), v.alias("value"))
    turn = F.struct(F.array(part(F.col("text")), part(F.lit("part two"))).alias("content"), F.coalesce("role", F.lit("")).alias("role"))
    rows = table(spark, sf_dir, "conversations").withColumn("m", F.get(conv.chat_messages(F.array(turn)), 0))
    return rows.select("conv_id", "turn", "m.role", "m.content")


@query(f"""WITH {_INDEXED} SELECT split, row_number() OVER (PARTITION BY split ORDER BY conv_id) - 1 AS row, n_tokens AS n_real, n_trained, max(n_tokens) OVER (PARTITION BY split) AS width FROM ix JOIN lens USING (conv_id, n_tokens)""")
def tensor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded arrays through tensor files of a few rows."""
    made = scratch.table(tensors.bundles(tokenize.padded(_indexed(spark, sf_dir), pad=0), 7), "tensors")
    rows = tensors.unbundled(made, 7)
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    trained = F.size(F.filter("labels", lambda x: x != tokenize.IGNORE)).cast("long")
    return rows.select("split", "row", total("attention_mask").alias("n_real"), trained.alias("n_trained"), F.size("input_ids").cast("long").alias("width"))


@query(f"WITH {_INDEXED} SELECT split, row_number() OVER (PARTITION BY split ORDER BY conv_id) - 1 AS row, 'c' || conv_id AS record_id FROM ix UNION ALL SELECT 'dropped', -1, 'c' || conv_id FROM lens WHERE k[1].r = 'assistant'")
def index_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the row index as one JSON document."""
    root = scratch.path(spark, "artifacts")
    target = f"{root}/artifacts/{RUN}"
    name = F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("record_id")
    _indexed(spark, sf_dir).select("split", "row", name).write.parquet(f"{target}/index")
    dropped = tokenize.tokenized(silver_turns(spark, sf_dir).select("conv_id", "conversation")).where("drop_reason is not null")
    dropped.select(name, F.col("drop_reason").alias("reason")).write.parquet(f"{target}/dropped")
    files.write_json(spark, f"{target}/index_map.json", {"run_id": RUN, "adapter": "word"})
    whole = spark.read.schema(schemas.INDEX_MAP_DDL).json(pipeline.export_index_map(spark, root, RUN), multiLine=True)
    parts = [whole.select(F.explode(f"splits.{s}").alias("e")).select(F.lit(s).alias("split"), F.col("e.row").cast("long").alias("row"), "e.record_id") for s in ("train", "eval")]
    lost = whole.select(F.explode("dropped").alias("e")).select(F.lit("dropped").alias("split"), F.lit(-1).cast("long").alias("row"), "e.record_id")
    return _union([*parts, lost])


@query(f"""WITH {_INDEXED}, e AS (SELECT conv_id, n_tokens, row_number() OVER (ORDER BY conv_id) - 1 AS row FROM ix WHERE split = 'eval')
SELECT 'c' || conv_id AS record_id, 'base ' || (len(c) - 1) AS base_output, 'tuned ' || (len(c) - 1) AS tuned_output, c[-1].v AS reference FROM e JOIN silver USING (conv_id) WHERE row < 3""")
def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of two stub models for the sample, as a written transcript."""
    name = F.concat(F.lit("c"), F.col("conv_id").cast("string"))
    index = _indexed(spark, sf_dir).select("split", F.col("row").cast("long"), name.alias("record_id"))
    gold = silver_turns(spark, sf_dir).select(name.alias("id"), "conversation", F.col("conv_id").alias("seq"))
    model = lambda word: lambda: lambda messages: f"{word} {len(messages)}"
    both = smoke.generated(smoke.generated(smoke.sample(index, gold, 3), model("base"), "base_output"), model("tuned"), "tuned_output")
    path = f"{scratch.path(spark, 'smoke')}/transcript.json"
    files.write_json(spark, path, {"samples": [r.asDict(recursive=True) for r in both.drop("prompt_messages").collect()]})  # three rows
    return spark.createDataFrame([tuple(s[c] for c in ("record_id", "base_output", "tuned_output", "reference")) for s in files.read_json(spark, path)["samples"]], "record_id string, base_output string, tuned_output string, reference string")


@query(f"WITH {_INDEXED} SELECT conv_id::VARCHAR AS record_id FROM ix WHERE conv_id % 4 = 1")
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index entries without a record."""
    index = _indexed(spark, sf_dir).select(F.col("conv_id").cast("string").alias("record_id"))
    gold = silver_turns(spark, sf_dir).where("conv_id % 4 != 1").select(F.col("conv_id").cast("string").alias("id"))
    return smoke.missing(index, gold)


# -- configuration, hooks ----------------------------------------------------------


@query("""WITH r AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
g AS (SELECT c_custkey, CASE
  WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 OR c_custkey % 19 = 0 OR c_custkey % 23 = 0 OR c_nationkey < 2 OR NOT c_acctbal / 8000 BETWEEN 0 AND 1 THEN 'config'
  WHEN c_custkey % 8 = 1 THEN 'hyperparameters' WHEN c_custkey % 8 = 2 THEN 'adapter' WHEN c_custkey % 8 = 3 THEN 'tokenizer' WHEN c_custkey % 8 = 4 THEN 'upstream'
  WHEN c_custkey % 8 = 5 OR n IS NULL THEN 'records' WHEN c_custkey % 8 = 6 THEN 'work' END AS gate FROM customer LEFT JOIN r ON o_custkey = c_custkey)
SELECT c_custkey, gate, CASE WHEN gate IS NULL THEN 0 WHEN gate = 'work' THEN 1 WHEN gate = 'records' THEN 3 ELSE 2 END AS code FROM g""")
def stage_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the stages of many runs stop, a run for each customer over their orders, and their exit codes: unknown
    keys and sections, wrong types, unknown maskers, no model, values out of range, hyperparameters, adapters, tokenizers, no upstream, no records, a bug."""
    k = F.col("c_custkey")
    key = lambda text, otherwise: F.when(k % 8 == text[0], text[1]).otherwise(otherwise)
    size = F.when(k % 11 == 0, '"x"').otherwise(F.coalesce((F.col("c_nationkey") - 2).cast("string"), F.lit("0")))
    parts = [
        F.lit('{"ingest":{"sources":[]},"judge":{"threshold":'), F.coalesce((F.col("c_acctbal") / 8000).cast("string"), F.lit("0")), F.lit('},"clean":{"min_chars":'), size,
        F.when(k % 13 == 0, ',"pii":["ssn"]').otherwise(',"pii":["email"]'), F.when(k % 7 == 0, ',"min":1').otherwise(""), F.lit('},"train":{"hyperparameters":{"lr":1}}'),
        F.when(k % 19 == 0, ',"more":{}').otherwise(""), F.when(k % 23 == 0, ',"tokenize":{"eval_fraction":"x"}').otherwise(""),
        F.when(k % 17 == 0, "").otherwise(key((2, ',"model":{"adapter":"none"}'), key((3, f',"model":{{"adapter":"library","tokenizer":"{scratch.path(spark, "none")}.json"}}'), ',"model":{"adapter":"word"}'))),
        F.lit("}"),
    ]
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    requests = table(spark, sf_dir, "customer").join(counts, "c_custkey", "left").select(
        "c_custkey", k.cast("string").alias("run_id"), F.concat(*parts).alias("config"), key((1, '{"rate":2}'), '{"lr":2}').alias("overrides"),
        (k % 8 != 4).alias("upstream"), F.when(k % 8 != 5, F.col("n")).alias("records"),
    )

    def work(config: cfg.Pipeline, run_id: str) -> None:
        if int(run_id) % 8 == 6:
            raise RuntimeError("a bug")

    return pipeline.outcomes(requests, work).select("c_custkey", "gate", "code")


@query("""WITH r AS (SELECT *, 'run-' || strftime(ts, '%Y%m%d-%H%M%S') || '-' || sha256(event_id::VARCHAR)[1:6] AS run_id, strftime(ts, '%Y%m%d')::BIGINT + strftime(ts, '%H%M%S')::BIGINT AS t FROM events)
SELECT event_id, event_type || '-' || run_id AS model_version, event_type AS adapter_name, 'weights/' || run_id AS weights_uri, (t % 997 / 16.0::DOUBLE)::DOUBLE AS final_eval_loss, 'candidate' AS status,
  'x/gold/' || run_id || '/manifest.json' AS gold_manifest_uri, 'x/artifacts/' || run_id || '/index_map.json' AS index_map_uri, (t % 1009 / 8.0::DOUBLE)::DOUBLE AS logged FROM r""")
def trained_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions as a trainer's hook gives them for runs of events, with derived names, read back from the registry, and their runs' records."""
    root = scratch.path(spark, "trained")
    # losses follow from a run's time, so that events with the same run agree on its record
    t = F.substring("run_id", 5, 8).cast("long") + F.substring("run_id", 14, 6).cast("long")
    runs = table(spark, sf_dir, "events").select("event_id", hashing.run_id(F.col("ts"), F.col("event_id")).alias("run_id"), F.col("event_type").alias("adapter_name"))
    runs = runs.withColumns({"t": t, "index_adapter": F.col("adapter_name")})

    def trainer(gated: DataFrame) -> DataFrame:
        return gated.withColumns({
            "weights_uri": F.concat(F.lit("weights/"), "run_id"), "base_model": F.lit("b"), "tracking_id": F.concat(F.lit("t-"), "run_id"),
            "final_train_loss": F.col("t") % 1009 / 8, "final_eval_loss": F.col("t") % 997 / 16,
        })

    asked = pipeline.train_many(runs, root, trainer).where("refused is null").select("event_id", F.concat_ws("-", "adapter_name", "run_id").alias("model_version"))
    records = tracking.search(spark, root, {"stage": "train"}).select("run_id", F.col("metrics").getItem("final_train_loss").alias("logged"))
    uri = lambda c: F.concat(F.lit("x"), F.substring(c, len(root) + 1, 1 << 20)).alias(c)
    found = registry_files.scan(spark, f"{root}/registry").where("valid").join(records, "run_id")
    return asked.join(found, "model_version").select("event_id", "model_version", "adapter_name", "weights_uri", "eval.final_eval_loss", "status", uri("gold_manifest_uri"), uri("index_map_uri"), "logged")


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey + 1 END, 0)::INT AS pad FROM orders""")
def pad_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: the padding token, or else the end token, or 0, of tokenizers described by rows."""
    pad, end = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") + 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", tokenize.pad_of(pad, end).alias("pad"))