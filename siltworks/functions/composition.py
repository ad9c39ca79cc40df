"""Normal form C as expressions.

Only runs of characters that composition can touch, each with the character before it,
are worked on: their characters are decomposed, marks are ordered by class, and a fold
composes them.  Everything outside such runs is in normal form already and cannot combine
with what is inside.  All tables come from ``unicodedata`` by the standard's rules.

Every text is tested here, so that one in any script goes through untouched if it is
composed already, as nearly all are.  The work itself takes some 50 microseconds a run, so texts
with more than ``FEW`` runs, and runs of ``LONG`` characters, are left to Python's.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .common import let

FEW, LONG = 16, 64
#: Parts of a table.
BUCKETS = 256
#: Hangul by rule: first leading consonant, vowel, trailing consonant and syllable, and how many there are (fixed values).
_L, _V, _T, _S, _LS, _VS, _TS = 0x1100, 0x1161, 0x11A7, 0xAC00, 19, 21, 28


@dataclass(frozen=True)
class Tables:
    split: dict[str, str]  # full canonical decompositions, Hangul aside
    order: dict[str, int]  # combining classes over 0
    pairs: dict[str, str]  # two characters that compose, and what to
    touched: str  # a character class: what composition can change or join to the character before


def _ranges(points: list[int]) -> str:
    out, i = [], 0
    while i < len(points):
        j = i
        while j + 1 < len(points) and points[j + 1] == points[j] + 1:
            j += 1
        out.append(f"\\x{{{points[i]:X}}}" + (f"-\\x{{{points[j]:X}}}" if j > i else ""))
        i = j + 1
    return "".join(out)


@functools.cache
def tables() -> Tables:
    split, order, pairs, touched = {}, {}, {}, set()
    for point in range(0xC0, sys.maxunicode + 1):
        if 0xD800 <= point < 0xE000 or _S <= point < _S + _LS * _VS * _TS:
            continue
        c = chr(point)
        if k := unicodedata.combining(c):
            order[c] = k
            touched.add(point)
        whole = unicodedata.normalize("NFD", c)
        if whole != c:
            split[c] = whole
            if unicodedata.normalize("NFC", c) != c:
                touched.add(point)
            first = [chr(int(x, 16)) for x in unicodedata.decomposition(c).split()]
            if len(first) == 2 and unicodedata.normalize("NFC", "".join(first)) == c:
                pairs["".join(first)] = c
                touched.add(ord(first[1]))
    touched |= {*range(_V, _V + _VS), *range(_T + 1, _T + _TS)}
    points = sorted(touched)
    rows = sorted({16 * (p // 16) + i for p in points for i in range(16)})
    # most characters are ruled out by one comparison, others by a few wide ranges before the many exact ones
    return Tables(split, order, pairs, f"[\\x{{{points[0]:X}}}-\\x{{10FFFF}}&&[{_ranges(rows)}]&&[{_ranges(points)}]]")


def _place(key: str) -> int:
    return (31 * ord(key[0]) + (ord(key[-1]) if len(key) > 1 else 0)) % BUCKETS


def _lookup(table: dict, kind: str, first: Column, second: Column | None = None) -> Column:
    """The table's value for one character or two, or null; a map is searched in order, so the table is many small ones."""
    parts: list[dict] = [{} for _ in range(BUCKETS)]
    for key, value in table.items():
        parts[_place(key)][key] = value
    held = F.from_json(F.lit(json.dumps(parts)), f"array<map<string,{kind}>>")
    spot, key = 31 * F.ascii(first), first
    if second is not None:
        spot, key = spot + F.ascii(second), F.concat(first, second)
    return F.try_element_at(F.get(held, spot % BUCKETS), key)


def touched(text: Column) -> Column:
    """Whether composition could change the text."""
    return text.rlike(tables().touched)


def dense(text: Column) -> Column:
    """Whether a touched text has too many runs, or too long a one, for ``composed``."""
    runs = tables().touched
    return (F.regexp_count(text, F.lit(f"{runs}+")) > FEW) | text.rlike(f"{runs}{{{LONG},}}")


def _run(run: Column) -> Column:
    t = tables()
    syllables = F.lit("".join(map(chr, range(_S, _S + _LS * _VS * _TS))))
    points = lambda s: F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))

    def pieces(c: Column) -> Column:
        whole = _lookup(t.split, "string", c)
        return F.when(whole.isNotNull(), points(whole)).otherwise(F.array(c))

    def classed(chars: Column) -> Column:
        return F.transform(chars, lambda c: F.struct(F.coalesce(_lookup(t.order, "int", c), F.lit(0)).alias("k"), c.alias("c")))

    def sorted_marks(items: Column) -> Column:
        # marks follow their starter in the order of their classes, equal ones as they came
        def place(x: Column, i: Column) -> Column:
            group = F.size(F.filter(F.slice(items, F.lit(1), i + 1), lambda y: y["k"] == 0))
            return F.struct(group.alias("g"), x["k"].alias("k"), i.alias("i"), x["c"].alias("c"))

        return F.array_sort(F.transform(items, place))

    def composed(a: Column, b: Column) -> Column:
        x, y = F.ascii(a), F.ascii(b)
        leading = (x >= _L) & (x < _L + _LS) & (y >= _V) & (y < _V + _VS)
        open_ = (x >= _S) & (x < _S + _LS * _VS * _TS) & ((x - _S) % _TS == 0) & (y > _T) & (y < _T + _TS)
        at = F.when(leading, ((x - _L) * _VS + (y - _V)) * _TS).when(open_, x - _S + (y - _T))
        return F.when(a == "", F.lit(None).cast("string")).when(at.isNotNull(), F.substring(syllables, at + 1, F.lit(1))).otherwise(_lookup(t.pairs, "string", a, b))

    def step(s: Column, x: Column) -> Column:
        free = (s["last"] == -1) | (s["last"] != 0) & (s["last"] < x["k"])

        def after(made: Column) -> Column:
            joined = F.struct(s["done"].alias("done"), made.alias("start"), s["tail"].alias("tail"), s["last"].alias("last"))
            begun = F.struct(F.concat(s["done"], s["start"], s["tail"]).alias("done"), x["c"].alias("start"), F.lit("").alias("tail"), F.lit(-1).alias("last"))
            marked = F.struct(s["done"].alias("done"), s["start"].alias("start"), F.concat(s["tail"], x["c"]).alias("tail"), x["k"].alias("last"))
            return F.when(made.isNotNull(), joined).when(x["k"] == 0, begun).otherwise(marked)

        return let(F.when(free, composed(s["start"], x["c"])), after)

    zero = F.struct(F.lit("").alias("done"), F.lit("").alias("start"), F.lit("").alias("tail"), F.lit(-1).alias("last"))
    fold = lambda items: F.aggregate(items, zero, step, lambda s: F.concat(s["done"], s["start"], s["tail"]))
    chars = F.flatten(F.transform(points(run), pieces))
    return let(chars, lambda cs: let(classed(cs), lambda items: let(sorted_marks(items), fold)))


def composed(text: Column) -> Column:
    """The text in normal form C."""
    pattern = f"(?s)(?:(?!{tables().touched}).)?{tables().touched}+"
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("runs"), F.split(text, pattern, -1).alias("gaps"))
    return let(both, lambda x: F.array_join(F.zip_with(x["gaps"], x["runs"], lambda g, r: F.concat(g, F.when(r.isNull(), "").otherwise(_run(r)))), ""))
