"""Mapping, structure, drop reasons and deduplication."""

import json

import pytest
from pyspark.sql import functions as F

from siltworks.functions import conversation as conv
from siltworks.operators import clean
from siltworks.schemas import CONVERSATION

USER = {"role": "user", "content": [{"type": "text", "value": "what is the answer to this?"}]}
BOT = {"role": "assistant", "content": [{"type": "text", "value": "it is forty two"}]}
SYSTEM = {"role": "system", "content": [{"type": "text", "value": "be brief"}]}
IMAGE = {"role": "user", "content": [{"type": "image", "value": "é.png"}]}


def reasons(spark, records, **limits):
    frame = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(records)], "seq long, raw string")
    mapped = frame.withColumn("m", clean.map_jsonl(F.col("raw"))).select("seq", "m.mappable", "m.conversation")
    return [r["drop_reason"] for r in clean.clean(mapped, **limits).orderBy("seq").collect()]


def wrapped(*turns):
    return {"conversation": list(turns)}


BROKEN = [
    wrapped(), wrapped(USER), wrapped(USER, USER), wrapped(BOT, BOT), wrapped(USER, BOT, USER), wrapped(USER, SYSTEM, BOT), wrapped(SYSTEM, SYSTEM, USER, BOT),
    wrapped(USER, "text"), wrapped(USER, {"role": "assistant"}), wrapped(USER, BOT | {"extra": 1}), wrapped(USER, BOT | {"role": "bot"}), wrapped(USER, BOT | {"role": 1}),
    wrapped(USER, BOT | {"content": []}), wrapped(USER, BOT | {"content": "x"}), wrapped(USER, BOT | {"content": [{"type": "video", "value": "x"}]}),
    wrapped(USER, BOT | {"content": [{"type": "text", "value": 1}]}), wrapped(USER, BOT | {"content": [{"type": "text"}]}), wrapped(USER, BOT | {"content": ["x"]}), wrapped(USER, None),
    {"prompt": "p", "response": 5}, {"prompt": ["x"], "response": "r"}, {"prompt": "p", "response": "r", "system": 1},
]
UNMAPPABLE = [
    {}, {"text": "x"}, {"prompt": "p"}, {"prompt": "", "response": "r"}, {"prompt": "p", "response": None}, {"prompt": 0, "response": "r"}, {"prompt": [], "response": "r"},
    {"prompt": "p", "response": False}, {"prompt": "p", "response": "r", "more": 1}, {"conversation": "x"}, {"conversation": None, "prompt": "p"},
]


def test_shapes(spark):
    good = [
        wrapped(USER, BOT), wrapped(SYSTEM, USER, BOT), {"prompt": "a question of length", "response": "r"}, {"question": "another question here", "answer": "a", "system": ""},
        {"prompt": "a third question there", "response": "r", "system": "s"}, wrapped(BOT, USER, BOT), wrapped(IMAGE, USER, BOT), {"conversation": [USER, BOT, USER, BOT], "other": 1},
    ]
    got = reasons(spark, good + BROKEN + UNMAPPABLE)
    assert got == [None] * len(good) + ["bad_structure"] * len(BROKEN) + ["unmappable"] * len(UNMAPPABLE)


def test_reasons_in_order(spark):
    say = lambda q, a: {"prompt": q, "response": a}
    records = [say("  ", "x" * 40), say("q" * 9, "a" * 10), say("q" * 10, "a" * 10), say("q" * 60, "a" * 41), say("mail a@b.de please", "to a@c.de now"), say("mail x@y.org please", "to z@c.de now"), say("q" * 10, "a" * 10), say("\x00" * 9, "y" * 50)]
    assert reasons(spark, records, min_chars=20, max_chars=100) == ["empty_turn", "too_short", None, "too_long", None, "duplicate", "duplicate", "empty_turn"]


def test_dropped_records_do_not_count_as_first(spark):
    frame = spark.createDataFrame([(0, "k", "too_short"), (1, "k", None), (2, "k", None), (3, None, None)], "seq long, k string, drop_reason string")
    got = {r["seq"]: r["drop_reason"] for r in clean.first_wins(frame, F.col("k")).collect()}
    assert got == {0: "too_short", 1: None, 2: "duplicate", 3: None}


def test_other_parts_stay(spark):
    frame = spark.createDataFrame([(json.dumps([IMAGE, {"role": "assistant", "content": [{"type": "text", "value": " é "}]}]),)], "j string")
    row = frame.select(conv.scrub_turns(F.from_json("j", CONVERSATION)).alias("c")).first()
    assert row["c"][0]["content"][0]["value"] == "é.png" and row["c"][1]["content"][0]["value"] == "é"


def test_csv_mapping(spark):
    rows = [('{"q":"ask","a":"say","s":"sys"}', 3), ('{"q":"ask","a":"say","s":""}', 2), ('{"q":"","a":"say"}', None), ('{"q":"ask"}', None), ('{"q":" ","a":"x"}', 2)]
    frame = spark.createDataFrame(rows, "raw string, want int")
    names = F.struct(F.lit("q").alias("prompt_column"), F.lit("a").alias("response_column"), F.lit("s").alias("system_column"))
    for r in frame.select("want", F.size(clean.map_csv(F.col("raw"), names)).alias("n"), clean.map_csv(F.col("raw"), names).isNull().alias("none")).collect():
        assert r["none"] == (r["want"] is None) and (r["none"] or r["n"] == r["want"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], f"seq long, conversation {CONVERSATION}")
    assert clean.clean(empty).count() == 0
    assert clean.counts(clean.clean(empty)).first().asDict() == {"read": 0, "written": 0, "dropped": 0, "conserved": True}


@pytest.mark.parametrize("roles,ok", [("u a", True), ("s u a", True), ("a u a", True), ("u", False), ("u s a", False), ("u a u", False), ("s a", False), ("", False)])
def test_well_formed(spark, roles, ok):
    names = {"u": "user", "a": "assistant", "s": "system"}
    turns = [{"content": [{"type": "text", "value": "x"}], "role": names[r]} for r in roles.split()]
    frame = spark.createDataFrame([(json.dumps(turns),)], "j string")
    assert frame.select(conv.well_formed(F.from_json("j", CONVERSATION))).first()[0] is ok
