"""Raw sources as rows (n, raw, error) with n counting from 1.

``raw`` is the record's canonical JSON.  A row that cannot be a record keeps a
null ``raw`` and says why in ``error``; ``first_error`` finds the earliest.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.hashing import canonical, canonical_json
from . import csv_blocks, scratch, sql_source


class SourceError(ValueError):
    """A source that is configured wrongly or cannot be read."""


class MalformedRecord(ValueError):
    """A source row that is no record."""


@dataclass(frozen=True)
class Mapping:
    prompt_column: str | None = None
    response_column: str | None = None
    system_column: str | None = None


@dataclass(frozen=True)
class Source:
    type: str
    uri: str
    mapping: Mapping | None = None
    key: str | None = None  # of a query: the column by which its rows are ordered and split


def with_ordinal(df: DataFrame, name: str = "n", stable: bool = False) -> DataFrame:
    """Number rows from 1 in the order of partitions, without moving them to one partition.

    Each partition's rows count on from those of the partitions before; their
    counts, a row per partition, are all that is gathered.  Rows are written once,
    as counting and numbering must see the same partitions; what comes straight
    from files is ``stable`` and need not be.
    """
    tagged = df.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    tagged = tagged if stable else scratch.table(tagged, "ordinals")
    counts = tagged.groupBy("_part").count().collect()
    before, offsets = 0, []
    for part, n in sorted((r["_part"], r["count"]) for r in counts):
        offsets.append((part, before))
        before += n
    starts = df.sparkSession.createDataFrame(offsets or [(-1, 0)], "_part int, _start long")
    return tagged.join(scratch.small(starts, len(offsets)), "_part").withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_part", "_at", "_start")


@F.pandas_udf(T.StructType([T.StructField("raw", T.StringType()), T.StructField("error", T.StringType())]))
def _parsed(lines: pd.Series) -> pd.DataFrame:
    """Lines as canonical JSON, or why they are no records."""

    def one(line: bytes | None) -> tuple[str | None, str | None]:
        try:
            text = bytes(line).decode("utf-8")
            value = json.loads(text)
            return (canonical(text), None) if isinstance(value, dict) else (None, f"expected an object, got {type(value).__name__}")
        except (ValueError, RecursionError) as e:
            return None, str(e)

    return pd.DataFrame([one(x) for x in lines], columns=["raw", "error"])


def read_jsonl(spark: SparkSession, source: Source) -> DataFrame:
    """Lines end at line feeds only, so a record may hold any other separator.

    They go to Python in Arrow batches: ``hashing.plain_json`` writes most of them in the JVM, but takes longer.
    """
    lines = spark.read.option("lineSep", "\n").text(source.uri).select(F.col("value").cast("binary").alias("line"))
    asked = with_ordinal(lines, stable=True).select("n", _parsed("line").alias("p"))
    return asked.select("n", "p.raw", "p.error")


def csv_header(spark: SparkSession, uri: str) -> list[str]:
    """The first record's fields, which can hold line feeds."""
    try:
        for most in (1, 100, 10_000):
            lines = spark.read.option("lineSep", "\n").text(uri).limit(most).select(F.col("value").cast("binary")).collect()
            quoted, taken = False, []
            for (line,) in lines:
                quoted, _ = csv_blocks.after(bytes(line), quoted)
                taken.append(bytes(line))
                if not quoted:
                    break
            if not quoted or len(lines) < most:
                break
        return next(csv_blocks.rows(b"\n".join(taken).decode("utf-8")), [])
    except Exception as e:
        raise SourceError(f"cannot read source {uri!r}: {e}") from e


def read_csv(spark: SparkSession, source: Source) -> DataFrame:
    """Quoted fields may hold line feeds, and one file is read by as many tasks as it has blocks."""
    check_mapping(spark, source)
    try:
        return csv_blocks.parsed(spark, source.uri)
    except csv_blocks.Unreadable as e:
        raise SourceError(str(e)) from e


def read_csv_split(spark: SparkSession, source: Source) -> DataFrame:
    """For files without line feeds in fields: Spark's own reader, which splits
    files.  Rows with more fields than the header are errors; empty fields are null."""
    check_mapping(spark, source)
    header = csv_header(spark, source.uri)
    schema = ", ".join([*(f"`{c}` string" for c in header), "_corrupt string"])
    rows = spark.read.schema(schema).csv(source.uri, header=True, quote='"', escape='"', columnNameOfCorruptRecord="_corrupt", mode="PERMISSIVE")
    bare = F.regexp_replace("_corrupt", '"(?:[^"]|"")*"', "")  # commas inside quotes part no fields
    wide = F.size(F.split(bare, ",")) > len(header)
    raw = F.to_json(F.struct(*sorted(header)), {"ignoreNullFields": "false"})
    bad = F.col("_corrupt").isNotNull() & wide
    rows = with_ordinal(rows.select(raw.alias("raw"), bad.alias("bad")), stable=True)
    return rows.select("n", F.when(~F.col("bad"), F.col("raw")).alias("raw"), F.when(F.col("bad"), F.lit("more fields than the header")).alias("error"))


def read_sql(spark: SparkSession, source: Source) -> DataFrame:
    """``uri`` is a query to the database that ``SILTWORKS_SQL_DSN`` names, in the order of ``key``."""
    dsn = os.environ.get("SILTWORKS_SQL_DSN")
    if not dsn or not source.key:
        raise SourceError("a sql source needs SILTWORKS_SQL_DSN and a key")
    try:
        found = sql_source.rows(spark, dsn, source.uri, source.key)
    except sql_source.QueryError as e:
        raise SourceError(str(e)) from e
    names = sorted(c for c in found.columns if c != sql_source.OFFSET)
    _check(source.mapping, names, "the query")
    raw = canonical_json(F.to_json(F.struct(*[f"`{c}`" for c in names]), {"ignoreNullFields": "false"}))
    return found.select((F.col(sql_source.OFFSET) + 1).alias("n"), raw.alias("raw"), F.lit(None).cast("string").alias("error"))


def check_mapping(spark: SparkSession, source: Source) -> None:
    _check(source.mapping, csv_header(spark, source.uri), repr(source.uri))


def _check(m: Mapping | None, header: list[str], where: str) -> None:
    for column in [m.prompt_column, m.response_column, m.system_column] if m else []:
        if column is not None and column not in header:
            raise SourceError(f"mapping column {column!r} not found in {where} header {header}")


#: Readers by source type; registering one here makes the type known to every plan.
READERS: dict[str, Callable[[SparkSession, Source], DataFrame]] = {"csv": read_csv, "jsonl": read_jsonl, "sql": read_sql}


def known(kind: Column) -> Column:
    """Whether a source type has a reader."""
    return F.coalesce(kind.isin(*READERS), F.lit(False))


def read(spark: SparkSession, source: Source) -> DataFrame:
    if source.type not in READERS:
        raise SourceError(f"unknown source type {source.type!r}; known types: {sorted(READERS)}")
    return READERS[source.type](spark, source)


def first_error(rows: DataFrame, order: str = "n") -> str | None:
    """The earliest error, or None."""
    found = rows.where("error is not null").orderBy(order).limit(1).collect()
    return f"record {found[0][order]}: {found[0]['error']}" if found else None
