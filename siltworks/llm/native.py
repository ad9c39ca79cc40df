"""Building blocks for column expressions of the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Values that a running sum appends to one array at a time.
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _appended(values: Column, start: Column) -> Column:
    zero = F.struct(start.cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        return let(acc["at"] + x, lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

    return F.aggregate(values, zero, add, lambda acc: acc["out"])


def running(values: Column) -> Column:
    """Running sums of an array of integers.

    An append copies an array, so sums are made in blocks: first the blocks'
    totals, then each block from its own start.
    """

    def summed(values: Column) -> Column:
        count = F.ceil(F.size(values) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))

        def whole(blocks: Column) -> Column:
            totals = _appended(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)), F.lit(0))
            return let(totals, lambda ends: F.flatten(F.transform(blocks, lambda x, i: _appended(x, F.coalesce(F.get(ends, i - 1), F.lit(0))))))

        return let(blocks, whole)

    return let(F.transform(values, lambda v: v.cast("long")), summed)
