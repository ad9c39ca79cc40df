"""Conversations as columns: building, predicates, rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import CONVERSATION, PART_TYPES, ROLES
from . import composition
from .text import nfc_barrier, scrub_normalised

#: Versioned rubric (fixed values).
RUBRIC = "judge-rubric-v1"
RUBRIC_TEXT = """You are an expert evaluator of AI assistant responses.

Score the conversation below on these dimensions, holistically, as a single integer
from 1 (worst) to 10 (best):
- Instruction adherence: does the assistant follow what was asked?
- Factual plausibility: is the answer plausible, not self-contradictory?
- Completeness: does it fully address the request?
- Tone and formatting: is it appropriately toned and well formatted?

Respond with ONLY a JSON object of this exact shape, and nothing else:
{"score": <integer 1-10>, "reasoning": "<one or two sentences>"}"""


def turn(role: Column | str, value: Column) -> Column:
    """A turn with one text part."""
    role = F.lit(role) if isinstance(role, str) else role
    part = F.struct(F.lit("text").alias("type"), value.alias("value"))
    return F.struct(F.array(part).alias("content"), role.alias("role"))


def from_flat(prompt: Column, response: Column, system: Column | None = None) -> Column:
    """A conversation from flat fields; null if the prompt or the response is null or empty."""
    full = lambda c: c.isNotNull() & (c != "")
    turns = [F.when(full(system), turn("system", system))] if system is not None else []
    return F.when(full(prompt) & full(response), F.array_compact(F.array(*turns, turn("user", prompt), turn("assistant", response))))


def count_role(conv: Column, role: str) -> Column:
    return F.size(F.filter(conv, lambda t: t["role"] == role))


def typed_ok(conv: Column) -> Column:
    """Roles and part types are known, contents are non-empty."""

    def ok(t: Column) -> Column:
        parts = F.forall(t["content"], lambda p: F.coalesce(p["type"].isin(*PART_TYPES) & p["value"].isNotNull(), F.lit(False)))
        return F.coalesce(t["role"].isin(*ROLES) & (F.size(t["content"]) > 0) & parts, F.lit(False))

    return F.forall(conv, ok)


def well_formed(conv: Column) -> Column:
    """Two turns or more; a system turn only in front; a user and an assistant; the assistant last."""
    no_later_system = ~F.exists(F.slice(conv, F.lit(2), F.greatest(F.size(conv), F.lit(1))), lambda t: t["role"] == "system")
    ends = F.element_at(F.transform(conv, lambda t: t["role"]), -1) == "assistant"
    shape = F.when(F.size(conv) < 2, F.lit(False)).otherwise(no_later_system & (count_role(conv, "user") > 0) & ends)
    return F.coalesce(typed_ok(conv) & shape, F.lit(False))


def _map_text(conv: Column, f) -> Column:
    def part(p: Column) -> Column:
        return F.struct(p["type"].alias("type"), F.when(p["type"] == "text", f(p["value"])).otherwise(p["value"]).alias("value"))

    return F.transform(conv, lambda t: F.struct(F.transform(t["content"], part).alias("content"), t["role"].alias("role")))


def normalised(conv: Column) -> Column:
    """The conversation with NFC texts, or null where normalisation changes nothing.

    It acts on the whole conversation as JSON: composition never creates or
    removes JSON syntax.
    """
    text = F.to_json(conv)
    return F.from_json(nfc_barrier(F.when(composition.touched(text), text)), CONVERSATION)


def scrub_normalised_turns(conv: Column, kinds=("email", "phone")) -> Column:
    """Scrub every text part but for normalisation; other parts stay as they are."""
    return _map_text(conv, lambda v: scrub_normalised(v, kinds))


def keep_other_parts(normal: Column, conv: Column) -> Column:
    """Normalised text parts, and the other parts as they were."""

    def part(n: Column, o: Column) -> Column:
        return F.when(o["type"] == "text", n).otherwise(o)

    return F.zip_with(normal, conv, lambda n, o: F.struct(F.zip_with(n["content"], o["content"], part).alias("content"), o["role"].alias("role")))


def scrub_turns(conv: Column, kinds=("email", "phone")) -> Column:
    return scrub_normalised_turns(F.coalesce(keep_other_parts(normalised(conv), conv), conv), kinds)


def texts(conv: Column) -> Column:
    return F.flatten(F.transform(conv, lambda t: F.transform(F.filter(t["content"], lambda p: p["type"] == "text"), lambda p: p["value"])))


def has_empty_text(conv: Column) -> Column:
    return F.exists(texts(conv), lambda v: v == "")


def total_chars(conv: Column) -> Column:
    return F.aggregate(texts(conv), F.lit(0).cast("long"), lambda a, v: a + F.length(v))


def all_text(conv: Column) -> Column:
    return F.forall(conv, lambda t: F.forall(t["content"], lambda p: p["type"] == "text"))


def chat_messages(conv: Column) -> Column:
    """array<struct<role, content>>: a turn's text parts joined by a blank line."""
    joined = lambda t: F.array_join(F.transform(t["content"], lambda p: p["value"]), "\n\n")
    return F.transform(conv, lambda t: F.struct(t["role"].alias("role"), joined(t).alias("content")))


def rubric_prompt(conv: Column) -> Column:
    def line(t: Column) -> Column:
        said = F.array_join(F.transform(F.filter(t["content"], lambda p: p["type"] == "text"), lambda p: p["value"]), " ")
        return F.concat(t["role"], F.lit(": "), said)

    return F.concat(F.lit(RUBRIC_TEXT + "\n\nConversation:\n"), F.array_join(F.transform(conv, line), "\n"))
