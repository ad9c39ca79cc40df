"""Text scrubbing: normalise, strip controls, mask personal data, tidy blank lines.

Everything is a built-in expression, Unicode normalisation included (see
``composition``); only texts with many or long runs of marks go to a UDF.
Whole conversations, whose plans are large already, go to it when any text is touched.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from . import composition
from .common import let

#: Patterns of masked personal data (fixed values); (?U) gives \d and \s their Unicode sense.
EMAIL = (
    r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
    r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}"
)
PHONE = (
    r"(?U)(?<!\d)(?:\+\d{1,3}[ ]?\(\d{3}\)[ ]?\d{3}[-\s]?\d{4}|\(\d{3}\)[ ]?\d{3}[-\s]?\d{4}"
    r"|\+\d{1,3}(?:[ ]\d{2,4}){2,4}|\d{3}-\d{3}-\d{4})(?!\d)"
)
#: The same for engines whose patterns have no look-around, with ASCII digits and white space: a number takes the
#: characters beside it, so of two with one character between them the second stays.
PHONE_APART = (
    r"(^|[^0-9])(?:\+[0-9]{1,3}[ ]?\([0-9]{3}\)[ ]?[0-9]{3}[-\s]?[0-9]{4}|\([0-9]{3}\)[ ]?[0-9]{3}[-\s]?[0-9]{4}"
    r"|\+[0-9]{1,3}(?:[ ][0-9]{2,4}){2,4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(\z|[^0-9])"
)
#: Maskers by name; registering a pattern here makes it available to every plan.
MASKERS: dict[str, str] = {"email": EMAIL, "phone": PHONE}

_CONTROLS = r"[\x00-\x08\x0B-\x1F\x7F-\x9F]"


@F.pandas_udf(T.StringType())
def nfc_rare(s: pd.Series) -> pd.Series:
    """Normal form C; give it null where the text needs none, which costs next to nothing."""
    return s.str.normalize("NFC")


#: For use below filters: predicates on its result stay above it, so neither it nor
#: what it feeds is evaluated again inside a pushed-down filter.
nfc_barrier = nfc_rare.asNondeterministic()


def nfc(c: Column) -> Column:
    touched = composition.touched(c)
    return F.coalesce(nfc_rare(F.when(touched & composition.dense(c), c)), F.when(touched, composition.composed(c)), c)


def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROLS, "")


def mask(c: Column, kinds: Sequence[str]) -> Column:
    for kind in kinds:
        if kind not in MASKERS:
            raise ValueError(f"unknown masker {kind!r}; known: {sorted(MASKERS)}")
        c = F.regexp_replace(c, MASKERS[kind], f"[{kind.upper()}]")
    return c


def strip(c: Column) -> Column:
    """Without white space at both ends, in its Unicode sense."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def tidy(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\n{4,}", "\n\n\n"))


def scrub_normalised(c: Column, kinds: Sequence[str] = ("email", "phone")) -> Column:
    """The chain after normalisation; usable inside higher-order functions."""
    return tidy(mask(strip_controls(c), kinds))


def scrub(c: Column, kinds: Sequence[str] = ("email", "phone")) -> Column:
    return scrub_normalised(nfc(c), kinds)


def scrub_apart(c: Column) -> Column:
    """The chain as SQL without look-around has it; see ``PHONE_APART``.  White space at the ends is ASCII."""
    # most texts have nothing like a number, which is told faster
    apart = lambda t: F.when(t.rlike(r"[0-9]{3}[-\s]?[0-9]{4}|\+[0-9]"), F.regexp_replace(t, PHONE_APART, "$1[PHONE]$2")).otherwise(t)
    masked = let(mask(strip_controls(nfc(c)), ["email"]), apart)
    return F.regexp_replace(F.regexp_replace(masked, r"\n{4,}", "\n\n\n"), r"^\s+|\s+\z", "")
