"""Canonical hashes, deterministic ids and the split rule."""

from __future__ import annotations

import hashlib
import json
import secrets
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def hash_struct(c: Column) -> Column:
    """Hash of a value of fixed schema whose struct fields are in alphabetical order.

    The text must be free of control characters other than tab and line feed,
    as scrubbed text is; JSON writers differ in how they escape the others.
    """
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(c, {"ignoreNullFields": "false"}), 256))


def canonical(text: str) -> str:
    """Canonical JSON of a JSON text: sorted keys, no spaces, non-ASCII kept; lone surrogates are an error."""
    made = json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    made.encode("utf-8")
    return made


def hash_text(canonical_json: str) -> str:
    return "sha256:" + hashlib.sha256(canonical_json.encode("utf-8", "surrogatepass")).hexdigest()


@F.pandas_udf(T.StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """Canonical JSON of arbitrary objects; null where the text is no JSON object."""

    def one(text: str | None) -> str | None:
        try:
            return canonical(text) if text is not None and isinstance(json.loads(text), dict) else None
        except (ValueError, RecursionError):
            return None

    return s.map(one)


def plain_json(text: Column) -> Column:
    """Canonical JSON of those objects that the JVM writes byte for byte as ``canonical`` does, null for all others.

    A parsed variant has its keys in order and refuses repeated ones.  Numbers that are no
    64-bit integers are left to Python, as the two write them differently; so are texts with
    ``\\u`` escapes, which can stand for control characters and lone surrogates, with raw
    control characters, and with anything but white space around one object.
    """
    # The parser ignores what follows a value, so the text is an array's first item and the second, which no
    # text can hold without an escape, says that the first was all of it.
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"\\u0001"]')))
    value = F.try_variant_get(both, "$[0]", "variant")
    kinds = F.when(F.try_variant_get(both, "$[1]", "string") == "\x01", F.schema_of_variant(value))
    bare = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    same = ~text.contains("\\u") & ~text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]") & text.rlike(r"^[ \t\r\n]*\{[\s\S]*\}[ \t\r\n]*$")
    return F.when(same & kinds.startswith("OBJECT") & ~bare.rlike("[0-9][.eE]|[0-9]{19}"), F.to_json(value))


def hash_json(canonical_text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(canonical_text, 256))


def record_id(*parts: Column) -> Column:
    """An id of UUID version 4 form made from its parts, so that a task that runs
    again gives the same one.  (Random ids would change on every evaluation.)"""
    h = F.sha2(F.concat_ws("|", *parts), 256)
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def assign_split(record: Column, eval_fraction: float) -> Column:
    """'eval' if the id's leading 32 hash bits, as a fraction, are below ``eval_fraction``."""
    share = F.conv(F.substring(F.sha2(record.cast("string"), 256), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))
    return F.when(share < F.lit(float(eval_fraction)), "eval").otherwise("train")


def run_id(at: Column, key: Column) -> Column:
    """The run identifier of a time and what tells runs of that time apart."""
    return F.concat(F.lit("run-"), F.date_format(at, "yyyyMMdd-HHmmss"), F.lit("-"), F.substring(F.sha2(key.cast("string"), 256), 1, 6))


def utc(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def new_run_id(now: datetime | None = None) -> str:
    return f"run-{(now or datetime.now(UTC)).astimezone(UTC):%Y%m%d-%H%M%S}-{secrets.token_hex(3)}"


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
