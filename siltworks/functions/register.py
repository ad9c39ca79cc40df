"""Names for SQL users: the library's functions in a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import hashing, replies, text


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def register(spark: SparkSession) -> list[str]:
    """Register nfc_text, canonical_json and parse_judge_reply, and as SQL
    functions, which Catalyst inlines, scrub_pii, canonical_hash and assign_split."""
    spark.udf.register("nfc_text", text.nfc_rare)
    spark.udf.register("canonical_json", hashing.canonical_json)
    spark.udf.register("parse_judge_reply", replies.parse_reply)
    scrubbed = f"regexp_replace(nfc_text(t), {_quoted(text._CONTROLS)}, '')"
    for kind in ("email", "phone"):
        scrubbed = f"regexp_replace({scrubbed}, {_quoted(text.MASKERS[kind])}, '[{kind.upper()}]')"
    scrubbed = f"regexp_replace(regexp_replace({scrubbed}, r'\\n{{4,}}', '\\n\\n\\n'), r'(?U)^\\s+|\\s+\\z', '')"
    bodies = {
        "scrub_pii(t STRING) RETURNS STRING": scrubbed,
        "canonical_hash(j STRING) RETURNS STRING": "concat('sha256:', sha2(canonical_json(j), 256))",
        "assign_split(i STRING, f DOUBLE) RETURNS STRING": "if(cast(conv(substring(sha2(i, 256), 1, 8), 16, 10) AS DOUBLE) / 4294967295D < f, 'eval', 'train')",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return ["nfc_text", "canonical_json", "parse_judge_reply", *(s.partition("(")[0] for s in bodies)]
