"""Fill-in-the-middle: texts cut at two token bounds and put in another order.

Method: a text is decoded to an array of UTF-32 code points; tokens end where a
code point that is no space is followed by one that is, which a comparison of
neighbouring classes and ``flatnonzero`` find for the whole text at once.  Two
bounds are picked by hashed rank, and the three slices are encoded and joined.

All that is random is taken from the SHA-256 of seed and id, so that a row comes
out the same in any run and any order.

Null texts count as empty; empty texts, texts that hold a sentinel, and those
that the draw leaves out stay as they are.  Equal rows come out equal.  Ids may be
null: they hash as no digits.  Spaces after the last word are a token of their own.
Texts are handled one at a time and whole, in four bytes for each code point.  An input
column with the name of an added one is replaced; others stay.  An empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def bounds(points: np.ndarray) -> np.ndarray:
    """Where tokens start and end: spaces with the word after them, or the spaces at the end."""
    if not len(points):
        return np.zeros(1, np.int64)
    space = (points == 0x20) | (points >= 0x09) & (points <= 0x0D)
    return np.r_[0, np.flatnonzero(~space[:-1] & space[1:]) + 1, len(points)]


def _text(points: np.ndarray) -> str:
    return points.tobytes().decode("utf-32-le")


def transform(docs: DataFrame, text: str = "text", doc: str = "doc_id", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """Add ``n_tokens``, ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` and ``spm`` are hundredths: of texts that are cut, and of those that have their suffix first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc).cast("string"), F.lit(""))), 256)
    taken = {c.lower() for c in docs.columns}
    free = next(x for x in ("_draw" + "_" * i for i in range(len(taken) + 1)) if not any(c.startswith(x) for c in taken))
    names = [f"{free}{i}" for i in range(4)]
    drawn = docs.withColumns({c: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i, c in enumerate(names)})
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    schema, keep = batches.extended(docs, more)

    def cut(whole: str, h: list[int]) -> tuple[int, str, int | None, int | None, str]:
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at = bounds(points)
        n = len(at) - 1
        if not whole or PREFIX in whole or SUFFIX in whole or MIDDLE in whole or h[2] % 100 >= rate:
            return n, "plain", None, None, whole
        i, j = sorted((int(at[h[0] % (n + 1)]), int(at[h[1] % (n + 1)])))
        prefix, middle, suffix = _text(points[:i]), _text(points[i:j]), _text(points[j:])
        if h[3] % 100 < spm:
            return n, "spm", i, j - i, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "psm", i, j - i, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for batch in batches.slices(whole, text):
                draws = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
                rows = [cut(t, h) for t, h in zip(batches.texts(batch.column(text)), draws, strict=True)]
                kinds = {"n_tokens": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
                yield batches.with_columns(batch, keep, {c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())})

    return batches.mapped(drawn, run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``transform`` was given, from its output and form."""
    at = lambda i: F.get(F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}"), F.lit(i))
    psm, spm = F.concat(at(1), at(3), at(2)), F.concat(at(2), at(3), at(1))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
