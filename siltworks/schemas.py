"""Record schemas and their validity as column expressions.

Struct fields stand in alphabetical order wherever a struct is hashed, so that
``to_json`` is canonical without further work.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

ROLES = ("system", "user", "assistant")
PART_TYPES = ("text", "image", "audio")
SOURCE_TYPES = ("csv", "jsonl", "sql", "pdf", "api")
TIERS = ("bronze", "silver", "gold")
METHODS = ("qlora", "full")
STATUSES = ("candidate", "promoted", "retired")

#: Drop reasons in the order in which a record is tested.
CLEAN_REASONS = ("unmappable", "bad_structure", "empty_turn", "too_short", "too_long", "duplicate")
ASSET_REASONS = (*CLEAN_REASONS, "bad_asset")
JUDGE_REASONS = ("judge_error", "below_threshold")
VETO_REASONS = ("vetoed", *JUDGE_REASONS)
TOKENIZE_REASONS = ("unsupported_modality", "over_max_len", "masking_mismatch")

PART = "struct<type:string,value:string>"
TURN = f"struct<content:array<{PART}>,role:string>"
CONVERSATION = f"array<{TURN}>"
SOURCE = "struct<uri:string,type:string,locator:string,ingested_at:string,ingestor_version:string>"
EVALUATION = "struct<score:double,judge_model:string,reasoning:string,evaluated_at:string>"
#: With the scores of evaluators of other modalities; records written before they came have none.
EVALUATION_WIDE = "struct<score:double,judge_model:string,reasoning:string,evaluated_at:string,modality_scores:map<string,double>>"
LINEAGE = "struct<bronze_content_hash:string,cleaner_version:string>"


def ddl(fields: str) -> T.StructType:
    return T._parse_datatype_string(fields)


BRONZE_DDL = f"id string, run_id string, source {SOURCE}, content_hash string, raw string, seq bigint"
SILVER_DDL = f"id string, run_id string, lineage {LINEAGE}, conversation {CONVERSATION}, evaluation {EVALUATION}, seq bigint"
MANIFEST_DDL = (
    "tier string, run_id string, created_at string, producer struct<stage:string,version:string>, "
    "input struct<tier:string,manifest_uri:string>, files array<string>, records_hash string, "
    "counts struct<read:bigint,written:bigint,dropped:bigint>, drops array<struct<reason:string,count:bigint>>"
)
REGISTRY_DDL = (
    "model_version string, run_id string, adapter_name string, base_model string, method string, created_at string, "
    "gold_manifest_uri string, index_map_uri string, weights_uri string, mlflow_run_id string, hyperparameters map<string,string>, "
    "eval struct<final_train_loss:double,final_eval_loss:double>, status string, "
    "superseded_by string, history array<struct<at:string,`from`:string,`to`:string,by:string>>"
)
#: Fields that a manifest has once its version has been promoted or retired.
REGISTRY_LATER = ("superseded_by", "history")
INDEX_MAP_DDL = (
    "run_id string, adapter string, tokenizer_id string, max_seq_len int, gold_manifest_uri string, "
    "splits struct<train:array<struct<row:int,record_id:string>>,eval:array<struct<row:int,record_id:string>>>, "
    "dropped array<struct<record_id:string,reason:string>>"
)

#: Formats of identifiers (fixed values).
HASH_RE = "^sha256:[0-9a-f]{64}$"
UUID4_RE = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
UTC_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?Z$"
RUN_RE = r"^run-\d{8}-\d{6}-[0-9a-f]{6}$"


def is_hash(c: Column) -> Column:
    return F.coalesce(c.rlike(HASH_RE), F.lit(False))


def is_record_id(c: Column) -> Column:
    return F.coalesce(F.lower(c).rlike(UUID4_RE), F.lit(False))


def is_utc(c: Column) -> Column:
    return F.coalesce(c.rlike(UTC_RE), F.lit(False))


def is_run_id(c: Column) -> Column:
    return F.coalesce(c.rlike(RUN_RE), F.lit(False))


def turn_ok(t: Column) -> Column:
    """A role of the list and at least one part, each of a known type with a value; text must not be blank."""
    from .functions.text import strip

    def part_ok(p: Column) -> Column:
        blank = (p["type"] == "text") & (strip(p["value"]) == "")
        return F.coalesce(p["type"].isin(*PART_TYPES) & p["value"].isNotNull() & ~blank, F.lit(False))

    return F.coalesce(t["role"].isin(*ROLES) & (F.size(t["content"]) > 0) & F.forall(t["content"], part_ok), F.lit(False))


def bronze_valid() -> Column:
    s = F.col("source")
    return (
        is_record_id(F.col("id")) & F.col("run_id").isNotNull() & is_hash(F.col("content_hash")) & F.col("raw").isNotNull()
        & F.coalesce(s["type"].isin(*SOURCE_TYPES), F.lit(False)) & s["uri"].isNotNull() & s["locator"].isNotNull() & is_utc(s["ingested_at"])
    )


def silver_valid() -> Column:
    from .functions.conversation import well_formed

    e = F.col("evaluation")
    scored = e.isNull() | F.coalesce(e["score"].between(0, 1) & is_utc(e["evaluated_at"]), F.lit(False))
    shape = well_formed(F.col("conversation")) & F.forall("conversation", turn_ok)
    return is_record_id(F.col("id")) & is_hash(F.col("lineage.bronze_content_hash")) & F.coalesce(shape, F.lit(False)) & scored


def gold_valid() -> Column:
    return silver_valid() & F.col("evaluation").isNotNull()


def registry_valid() -> Column:
    text = ["model_version", "run_id", "adapter_name", "base_model", "gold_manifest_uri", "index_map_uri", "weights_uri", "mlflow_run_id"]
    ok = is_utc(F.col("created_at")) & F.col("hyperparameters").isNotNull() & F.col("eval.final_train_loss").isNotNull() & F.col("eval.final_eval_loss").isNotNull()
    ok = ok & F.coalesce(F.col("method").isin(*METHODS), F.lit(False)) & F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    for c in text:
        ok = ok & F.col(c).isNotNull()
    return F.coalesce(ok, F.lit(False))
