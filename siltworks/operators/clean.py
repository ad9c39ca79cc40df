"""Silver: map, test, scrub and deduplicate records, with one drop reason each.

A reason is decided by one CASE in a fixed order; the first failure counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import conversation as conv
from ..functions.common import let
from ..functions.hashing import hash_struct
from ..schemas import CONVERSATION
from ..sources import scratch

#: Flat shapes by their exact key sets (fixed values): prompt and response keys.
FLAT_SHAPES = {
    ("prompt", "response"): ("prompt", "response"),
    ("prompt", "response", "system"): ("prompt", "response"),
    ("answer", "question"): ("question", "answer"),
    ("answer", "question", "system"): ("question", "answer"),
}

EMPTY = f"cast(array() as {CONVERSATION})"


def map_csv(raw: Column, mapping: Column) -> Column:
    """A conversation from a CSV row; ``mapping`` has the columns' names."""

    def mapped(fields: Column) -> Column:
        pick = lambda c: F.when(mapping[c].isNotNull(), F.try_element_at(fields, mapping[c]))
        values = F.struct(*[pick(f"{c}_column").alias(c) for c in ("prompt", "response", "system")])
        return let(values, lambda v: conv.from_flat(v["prompt"], v["response"], v["system"]))

    return let(F.from_json(raw, "map<string,string>"), mapped)


def _typed(v: Column) -> Column:
    """struct(truthy, text) of a JSON value: whether it is anything but null,
    false, zero or empty, and its text if it is a string."""

    def of(x: Column) -> Column:
        v, kind = x["v"], x["kind"]
        text = F.try_variant_get(v, "$", "string")
        truthy = (
            F.when(v.isNull() | (kind == "VOID"), False)
            .when(kind == "STRING", text != "")
            .when(kind == "BOOLEAN", text == "true")
            .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
            .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
            .otherwise(F.try_variant_get(v, "$", "double") != 0)
        )
        return F.struct(F.coalesce(truthy, F.lit(False)).alias("truthy"), F.when(kind == "STRING", text).alias("text"))

    return let(F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")), of)


def _adopted(turns: Column) -> Column:
    """A typed conversation from an array of JSON values; null if a value has the wrong type or extra keys."""

    def text(v: Column) -> Column:
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))

    def keys(v: Column) -> Column:
        return F.sort_array(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")))

    def part(p: Column) -> Column:
        fields = F.struct(text(F.try_variant_get(p, "$.type", "variant")).alias("type"), text(F.try_variant_get(p, "$.value", "variant")).alias("value"))
        return F.when(keys(p) == F.array(F.lit("type"), F.lit("value")), fields)

    def turn(t: Column) -> Column:
        parts = F.transform(F.try_variant_get(t, "$.content", "array<variant>"), part)
        fields = F.struct(parts.alias("content"), text(F.try_variant_get(t, "$.role", "variant")).alias("role"))

        def whole(x: Column) -> Column:
            good = x["role"].isNotNull() & F.forall(x["content"], lambda p: p["type"].isNotNull() & p["value"].isNotNull())
            return F.when(good, x)

        return F.when(keys(t) == F.array(F.lit("content"), F.lit("role")), let(fields, whole))

    return let(F.transform(turns, turn), lambda made: F.when(F.coalesce(F.forall(made, lambda t: t.isNotNull()), F.lit(False)), made))


def _nothing() -> Column:
    return F.struct(F.lit(False).alias("mappable"), F.lit(None).cast(CONVERSATION).alias("conversation"))


def map_jsonl(raw: Column) -> Column:
    """struct(mappable, conversation) of a JSON record.

    A conversation that cannot be typed is mappable with a null conversation,
    which the structure test rejects.
    """

    def flat(value: Column, prompt_key: str, response_key: str) -> Column:
        fields = F.struct(*[_typed(F.try_variant_get(value, f"$.{k}", "variant")).alias(n) for k, n in ((prompt_key, "p"), (response_key, "r"), ("system", "s"))])

        def made(x: Column) -> Column:
            usable = x["p"]["truthy"] & x["r"]["truthy"]
            typed = x["p"]["text"].isNotNull() & x["r"]["text"].isNotNull() & (~x["s"]["truthy"] | x["s"]["text"].isNotNull())
            turns = F.array_compact(F.array(F.when(x["s"]["truthy"], conv.turn("system", x["s"]["text"])), conv.turn("user", x["p"]["text"]), conv.turn("assistant", x["r"]["text"])))
            return F.struct(usable.alias("mappable"), F.when(usable & typed, turns).alias("conversation"))

        return let(fields, made)

    def mapped(x: Column) -> Column:
        given = F.try_variant_get(x["value"], "$.conversation", "variant")
        is_list = F.coalesce(F.schema_of_variant(given).startswith("ARRAY"), F.lit(False))
        adopted = F.struct(F.lit(True).alias("mappable"), _adopted(F.try_variant_get(given, "$", "array<variant>")).alias("conversation"))
        out = F.when(is_list, adopted)
        for shape, (p, r) in FLAT_SHAPES.items():
            out = out.when(x["keys"] == F.array(*[F.lit(k) for k in shape]), flat(x["value"], p, r))
        return out.otherwise(_nothing())

    return let(F.struct(F.try_parse_json(raw).alias("value"), F.sort_array(F.json_object_keys(raw)).alias("keys")), mapped)


def map_records(bronze: DataFrame, mappings: DataFrame) -> DataFrame:
    """Add ``mappable`` and ``conversation``; ``mappings`` has a row per source uri
    (uri, prompt_column, response_column, system_column), as many as are configured."""
    known = mappings.select(F.col("uri").alias("_uri"), F.struct("prompt_column", "response_column", "system_column").alias("_mapping"))
    joined = bronze.join(F.broadcast(known), F.col("source.uri") == F.col("_uri"), "left").drop("_uri")
    kind = F.col("source.type")
    from_csv = let(map_csv(F.col("raw"), F.col("_mapping")), lambda c: F.struct(c.isNotNull().alias("mappable"), c.alias("conversation")))
    mapped = F.when(kind.isin("csv", "sql"), from_csv).when(kind == "jsonl", map_jsonl(F.col("raw"))).otherwise(_nothing())
    return joined.withColumn("_m", mapped).withColumns({"mappable": F.col("_m.mappable"), "conversation": F.col("_m.conversation")}).drop("_m", "_mapping")


def tested(mapped: DataFrame, pii: Sequence[str] = ("email", "phone"), min_chars: int = 20, max_chars: int = 32_000) -> DataFrame:
    """Scrub conversations and add ``drop_reason`` (null: passed), duplicates aside.

    Needs ``conversation``, and uses ``mappable`` where there is one.
    """
    mappable = F.col("mappable") if "mappable" in mapped.columns else F.col("conversation").isNotNull()

    def shape(x: Column) -> Column:
        ok = conv.well_formed(x["c"])
        return let(ok, lambda ok: F.struct(x["m"].alias("m"), ok.alias("ok"), F.when(ok, x["c"]).alias("c")))

    shaped = mapped.withColumn("_s", let(F.struct(mappable.alias("m"), F.col("conversation").alias("c")), shape))
    # normalisation is the one step outside Spark's functions, so it splits the expression in two
    normal = shaped.withColumn("_n", conv.normalised(F.col("_s.c")))

    def judge(c: Column) -> Column:
        size = let(conv.total_chars(c), lambda n: F.when(n < min_chars, "too_short").when(n > max_chars, "too_long"))
        reason = F.when(~F.col("_s.m"), "unmappable").when(~F.col("_s.ok"), "bad_structure").when(conv.has_empty_text(c), "empty_turn").otherwise(size)
        return F.struct(c.alias("conversation"), reason.alias("drop_reason"))

    done = normal.withColumn("_t", let(conv.scrub_normalised_turns(F.coalesce(conv.keep_other_parts(F.col("_n"), F.col("_s.c")), F.col("_s.c")), pii), judge))
    kept = [c for c in mapped.columns if c not in ("conversation", "mappable", "drop_reason")]
    return done.select(*kept, F.col("_t.conversation").alias("conversation"), F.col("_t.drop_reason").alias("drop_reason"))


def first_wins(flagged: DataFrame, key: Column, seq: str = "seq") -> DataFrame:
    """Turn all but the first passing record of each key into duplicates.

    The records are written once, as both sides of the join below read them.
    The first places are partial minima by key; they join back by ``seq``,
    which is unique, so a key with very many copies is never in one place.
    """
    keyed = scratch.table(flagged.withColumn("_key", F.when(F.col("drop_reason").isNull(), key)), "first-wins")
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(seq).alias("_first")).select("_first")
    joined = keyed.join(first, F.col(seq) == F.col("_first"), "left")
    again = F.col("_key").isNotNull() & F.col("_first").isNull()
    return joined.withColumn("drop_reason", F.when(again, "duplicate").otherwise(F.col("drop_reason"))).drop("_key", "_first")


def clean(mapped: DataFrame, pii: Sequence[str] = ("email", "phone"), min_chars: int = 20, max_chars: int = 32_000) -> DataFrame:
    """Every record with its scrubbed conversation and its reason, duplicates included."""
    return first_wins(tested(mapped, pii, min_chars, max_chars), hash_struct(F.col("conversation")))


def silver(flagged: DataFrame, version: str = "0.1.0") -> DataFrame:
    from ..schemas import EVALUATION

    lineage = F.struct(F.col("content_hash").alias("bronze_content_hash"), F.lit(version).alias("cleaner_version"))
    return flagged.where("drop_reason is null").select("id", "run_id", lineage.alias("lineage"), "conversation", F.lit(None).cast(EVALUATION).alias("evaluation"), "seq")


def drop_counts(flagged: DataFrame) -> DataFrame:
    return flagged.where("drop_reason is not null").groupBy("drop_reason").agg(F.count("*").alias("n")).orderBy("drop_reason")


def counts(flagged: DataFrame) -> DataFrame:
    """read, written, dropped and whether they add up, in one row."""
    out = flagged.agg(F.count("*").alias("read"), F.count_if(F.col("drop_reason").isNull()).alias("written"), F.count_if(F.col("drop_reason").isNotNull()).alias("dropped"))
    return out.withColumn("conserved", F.col("read") == F.col("written") + F.col("dropped"))
