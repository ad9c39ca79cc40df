"""The order in which rows are trained on: a keyed permutation of each epoch, without a sort.

A swap-or-not network permutes 0 to n - 1 for any n: in each round a row may change places with a
partner, and both decide by one bit of the larger of the two places, so no two rows ever meet.
A row's step and slot are an expression of its number, computed where the row lies.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.common import let

ROUNDS = 24
#: A prime under 2**31, so that products of two remainders fit 63 bits.
PRIME = (1 << 31) - 1


def keys(seed: int, epoch: int, n: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """(partner sum, factor, shift) of each round, from the SHA-256 of seed, epoch and round."""
    out = []
    for r in range(rounds):
        h = hashlib.sha256(f"{seed}:{epoch}:{r}".encode()).digest()
        part = [int.from_bytes(h[8 * i : 8 * i + 8], "big") for i in range(3)]
        out.append((part[0] % max(n, 1), 1 + part[1] % (PRIME - 1), part[2] % PRIME))
    return out


def place(row: Column, n: int, seed: int, epoch: int, rounds: int = ROUNDS) -> Column:
    """The row's place in an epoch, from 0 to n - 1."""
    if n > PRIME:
        raise ValueError(f"more than {PRIME} rows: give each split its own numbers")
    steps = F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip("kab", key, strict=True)]) for key in keys(seed, epoch, n, rounds)])

    def swapped(x: Column, s: Column) -> Column:
        def with_partner(y: Column) -> Column:
            mixed = (F.greatest(x, y) * s["a"] + s["b"]) % F.lit(PRIME)
            return F.when((mixed * mixed + s["b"]) % F.lit(PRIME) % 2 == 1, y).otherwise(x)

        return let(F.pmod(s["k"] - x, F.lit(n).cast("long")), with_partner)

    return F.aggregate(steps, row.cast("long"), swapped)


def scheduled(rows: DataFrame, n: int, epochs: int, batch: int, seed: int = 42, row: str = "row") -> DataFrame:
    """Each row once per epoch, with ``epoch``, ``step`` and ``slot`` (from 0); ``row`` counts from 0 to n - 1.

    The last step of an epoch has what is left.  A narrow plan: a row becomes ``epochs`` rows.
    """
    if batch < 1 or epochs < 0:
        raise ValueError("a batch has a row at least")
    each = F.array(*[F.struct(F.lit(e).cast("long").alias("epoch"), place(F.col(row), n, seed, e).alias("at")) for e in range(epochs)]) if epochs else F.expr("cast(array() as array<struct<epoch:bigint,at:bigint>>)")
    out = rows.withColumn("_e", F.explode(each))
    return out.withColumns({"epoch": F.col("_e.epoch"), "step": F.floor(F.col("_e.at") / batch).cast("long"), "slot": (F.col("_e.at") % batch).cast("long")}).drop("_e")
