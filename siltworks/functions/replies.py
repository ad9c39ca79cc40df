"""Judge replies: the first scored JSON object in free text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

REPLY = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("reasoning", T.StringType())])
#: Characters looked at in one reply, over all starts (fixed value).
SCAN_BUDGET = 200_000


_DECODER = json.JSONDecoder()
#: What matters for finding an object's end: escapes, quotes and braces.
_MARK = re.compile(r'\\.|["{}]', re.DOTALL)


def _end(text: str, start: int, limit: int) -> int:
    """One past the brace that closes the one at ``start``; 0 if none does before ``limit``."""
    depth, quoted = 0, False
    for mark in _MARK.finditer(text, start, limit):
        kind = mark.group()
        if kind == '"':
            quoted = not quoted
        elif not quoted and kind in "{}":
            depth += 1 if kind == "{" else -1
            if not depth:
                return mark.end()
        # outside strings a backslash escapes nothing, but what follows it was passed over
        elif not quoted and kind[1] in '"{}':
            if kind[1] == '"':
                quoted = True
            else:
                depth += 1 if kind[1] == "{" else -1
                if not depth:
                    return mark.end()
    return 0


def _verdict(value: dict) -> tuple[int, str] | None:
    score, reasoning = value["score"], value.get("reasoning", "")
    return (score, reasoning) if type(score) is int and 1 <= score <= 10 and isinstance(reasoning, str) else None


def parse(text: str | None) -> tuple[int, str] | None:
    """(score, reasoning) of a reply, or None.

    Every brace may open an object.  The first object with a score decides,
    valid or not.  A span of balanced braces that is no JSON is passed over whole.
    """
    if not isinstance(text, str):
        return None
    left, at = SCAN_BUDGET, text.find("{")
    while at >= 0 and left > 0:
        step = 1
        try:
            value, end = _DECODER.raw_decode(text, at)
        except (ValueError, RecursionError):
            value, end = None, _end(text, at, min(len(text), at + left))
            step = max(1, end - at)
        if end - at > left:
            return None
        if isinstance(value, dict) and "score" in value:
            return _verdict(value)
        left -= (end or len(text)) - at
        at = text.find("{", at + step)
    return None


@F.pandas_udf(REPLY)
def parse_reply(s: pd.Series) -> pd.DataFrame:
    """Struct of score and reasoning; both null for a malformed reply."""
    found = [parse(t) or (None, None) for t in s]
    return pd.DataFrame(found, columns=["score", "reasoning"]).astype({"score": "Int32"})


def normalised(score: Column) -> Column:
    return score.cast("double") / F.lit(10.0)


def retryable(status: Column) -> Column:
    """Of an HTTP status as text, or 'timeout'."""
    return (status == "timeout") | (status == "429") | status.rlike("^5[0-9]{2}$")


#: The stand-in judge's marks, in the order in which they count, and its score without one (fixed values).
MARKS = {"fail_once": r"\[\[fail_once=(\d+)\]\]", "fail": r"\[\[fail=(\d+)\]\]", "garbage": r"\[\[garbage\]\]", "score": r"\[\[score=(\d+)\]\]"}
DEFAULT_SCORE = 8


def marked_outcome(text: Column, attempt: int = 1) -> Column:
    """Stand-in judge: struct(status, score) of an attempt.

    A failure mark gives its HTTP status, once or always; garbage is an answer
    without a score; else the marked score counts, or the default.
    """
    number = lambda k: F.nullif(F.regexp_extract(text, MARKS[k], 1), F.lit("")).cast("int")
    once = number("fail_once") if attempt == 1 else F.lit(None).cast("int")
    status = F.coalesce(once, number("fail"), F.lit(200))
    score = F.when((status == 200) & ~text.rlike(MARKS["garbage"]), F.coalesce(number("score"), F.lit(DEFAULT_SCORE)))
    return F.struct(status.alias("status"), score.alias("score"))


def marked_score(text: Column, retries: int = 3) -> Column:
    """The stand-in judge's score after retries; null for a judge error.

    Scores out of range are malformed answers, which retries do not mend.
    """
    first, again = marked_outcome(text), marked_outcome(text, 2)
    tried = F.when(retryable(first["status"].cast("string")) & F.lit(retries > 0), again["score"]).otherwise(first["score"])
    return F.when(tried.between(1, 10), tried)
