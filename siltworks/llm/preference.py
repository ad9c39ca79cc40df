"""Preference formatting, in DataFrame functions only.

Method: a chosen and a rejected conversation are compared turn by turn.  Their
longest common turn prefix is rendered once as the prompt; each rest is
rendered as a completion with a mask: the ranges of its text (code points, end
exclusive) that a model is trained on, which are its assistant turns with
their end marks.

A turn renders as ``<|role|>``, newline, content, ``<|end|>``, newline.  Null
conversations count as empty; null roles and contents as empty strings.  Pairs
that are equal throughout have empty completions.  Repeated rows give repeated
results; an empty table gives an empty result.  Added columns take the place
of input columns with their names; the name ``_preference`` is reserved.  Turns
without a conversation id belong to no conversation and are left out; turns that
tie in their number stand in the order of role and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import native
from .native import let

END = "<|end|>\n"
TURN = "array<struct<role:string,content:string>>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["content"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Ranges of the rendered text that are assistant turns."""

    def spans(steps: Column) -> Column:
        ends = native.running(F.transform(steps, lambda x: x["h"] + x["b"]))
        placed = F.zip_with(steps, ends, lambda x, e: F.struct((e - x["b"]).cast("int").alias("s"), e.cast("int").alias("e"), x["on"].alias("on")))
        return F.transform(F.filter(placed, lambda x: x["on"]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))

    return native.let(F.transform(turns, lambda t: F.struct(F.length(_head(t)).alias("h"), F.length(_body(t)).alias("b"), (t["role"] == "assistant").alias("on"))), spans)


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Turns in the longest common prefix."""
    differ = F.zip_with(chosen, rejected, lambda a, b: ~a.eqNullSafe(b))
    first = F.array_position(differ, True)
    return F.when(first == 0, F.least(F.size(chosen), F.size(rejected))).otherwise(first - 1).cast("int")


def _plain(conversation: str) -> Column:
    turns = F.coalesce(F.col(conversation).cast(TURN), F.expr(f"cast(array() as {TURN})"))
    empty = F.lit("")
    return F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], empty).alias("role"), F.coalesce(t["content"], empty).alias("content")))


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Add ``n_prompt_turns``, ``prompt`` and, for each side, ``*_completion`` and ``*_mask``."""

    def parts(both: Column) -> Column:
        n = common_turns(both["c"], both["r"])

        def cut(n: Column) -> Column:
            rest = {k: F.slice(both[k], n + 1, F.greatest(F.size(both[k]) - n, F.lit(0))) for k in "cr"}
            return F.struct(
                n.alias("n"), render(F.slice(both["c"], F.lit(1), n)).alias("p"),
                *[f.alias(k + name) for k in "cr" for name, f in (("t", render(rest[k])), ("m", mask(rest[k])))],
            )

        return let(n, cut)

    made = pairs.withColumn("_preference", let(F.struct(_plain(chosen).alias("c"), _plain(rejected).alias("r")), parts))
    new = {"n_prompt_turns": "n", "prompt": "p", "chosen_completion": "ct", "chosen_mask": "cm", "rejected_completion": "rt", "rejected_mask": "rm"}
    return made.withColumns({k: F.col(f"_preference.{v}") for k, v in new.items()}).drop("_preference")


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation with its turns in order; a conversation is one row by nature."""
    row = F.struct(F.col(turn).alias("turn"), F.col("role").alias("role"), F.col("text").alias("content"))
    return turns.where(F.col(conv).isNotNull()).groupBy(conv).agg(F.transform(F.array_sort(F.collect_list(row)), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("chosen"))


def with_rejected(convs: DataFrame) -> DataFrame:
    """Give each conversation a rejected twin: its last assistant turn replaced
    by an earlier reply of its own or, without one, by the turn before it (an echo).

    Conversations without an assistant turn are their own twin.
    """

    def twin(turns: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: F.get(turns, i - 1)["role"] == "assistant")

        def swap(at: Column) -> Column:
            last = F.element_at(at, -1)
            earlier = F.when(F.size(at) > 1, F.get(turns, at[0] - 1)["content"]).otherwise(F.coalesce(F.get(turns, last - 2)["content"], F.lit("")))
            reply = F.array(F.struct(F.lit("assistant").alias("role"), earlier.alias("content")))
            return F.when(F.size(at) == 0, turns).otherwise(F.concat(F.slice(turns, F.lit(1), last - 1), reply))

        return let(spots, swap)

    return convs.withColumn("rejected", let(F.col("chosen"), twin))
