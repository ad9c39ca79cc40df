"""Building blocks for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Without it an expression that is used n times is planned, and often
    evaluated, n times; nested uses multiply.
    """
    return F.transform(F.array(value), body)[0]
