"""Rows of a database query, read in partitions through Spark's data source API.

``spark.read.format("siltworks_sql")`` with options ``dsn``, ``query`` and ``key`` gives
the query's columns and ``_offset``, a row's place from 0 in the order of the key and
then of all columns, so that it is the same in every read of the same data.  The
planner asks the database for the key at every ``rows``-th place; a task reads its
key range and keeps its own places, so rows that share a key are split as well.
Under the name ``siltworks_sql_pushed`` filters that the database decides like Spark
does go into the query, outside the numbering.  Spark 4.1 keeps what was pushed with the
frame that ``load`` gave, for its later uses too, so such a frame is for one query.

Columns are bigint, double, string or binary by what the database stores in them; mixed
ones are strings, on which no filter is pushed.  Null keys come first.  A query without
rows gives none.  A database that changes while it is read has no snapshot here.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import datasource as api

NAME, PUSHED, OFFSET = "siltworks_sql", "siltworks_sql_pushed", "_offset"
#: Rows of a partition.
ROWS = 50_000
_KINDS = {frozenset({"integer"}): T.LongType(), frozenset({"real"}): T.DoubleType(), frozenset({"integer", "real"}): T.DoubleType(), frozenset({"text"}): T.StringType(), frozenset({"blob"}): T.BinaryType()}
_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
_COMPARE = {api.EqualTo: "=", api.GreaterThan: ">", api.GreaterThanOrEqual: ">=", api.LessThan: "<", api.LessThanOrEqual: "<="}


class QueryError(ValueError):
    """A database or a query that cannot be read."""


def _sqlite(rest: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{rest}?mode=ro", uri=True)


#: Connections by the scheme of the DSN; a driver registered here must be importable by the tasks.
DRIVERS: dict[str, Callable[[str], Any]] = {"sqlite": _sqlite}


def connect(dsn: str) -> Any:
    scheme, _, rest = dsn.partition("://")
    if scheme not in DRIVERS:
        raise QueryError(f"no driver for {scheme!r}; known: {sorted(DRIVERS)}")
    try:
        return DRIVERS[scheme](rest)
    except Exception as e:
        raise QueryError(f"cannot open the database: {e}") from e


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _asked(dsn: str, sql: str, params: Iterable[Any] = ()) -> tuple[list[str], list[tuple]]:
    con = connect(dsn)
    try:
        cursor = con.execute(sql, tuple(params))
        return [d[0] for d in cursor.description], cursor.fetchall()
    except Exception as e:
        raise QueryError(f"cannot read the query: {e}") from e
    finally:
        con.close()


def columns(dsn: str, query: str) -> dict[str, T.DataType]:
    """The query's columns and their types, by one scan in the database."""
    names, _ = _asked(dsn, f"SELECT * FROM ({query}) LIMIT 0")
    if len({n.lower() for n in [*names, OFFSET]}) <= len(names):
        raise QueryError(f"column names must differ, and from {OFFSET}: {names}")
    kinds = ", ".join(f"group_concat(DISTINCT CASE WHEN {_quoted(n)} IS NOT NULL THEN typeof({_quoted(n)}) END)" for n in names)
    _, (found,) = _asked(dsn, f"SELECT {kinds} FROM ({query})")
    return {n: _KINDS.get(frozenset((k or "text").split(",")), T.StringType()) for n, k in zip(names, found, strict=True)}


def pure(dsn: str, query: str, names: list[str]) -> set[str]:
    """Columns whose values are all of one type, on which the database compares like Spark."""
    kinds = ", ".join(f"count(DISTINCT CASE WHEN {_quoted(n)} IS NOT NULL THEN typeof({_quoted(n)}) END)" for n in names)
    _, (found,) = _asked(dsn, f"SELECT {kinds} FROM ({query})")
    return {n for n, k in zip(names, found, strict=True) if k <= 1}


class Range(api.InputPartition):
    """Places from ``first`` to before ``last``; the keys at both ends, and the place of the first row with the lower one."""

    def __init__(self, first: int, last: int | None, low: Any, base: int, high: Any):
        super().__init__(first)
        self.first, self.last, self.low, self.base, self.high = first, last, low, base, high


class Reader(api.DataSourceReader):
    def __init__(self, dsn: str, query: str, key: str, rows: int, schema: T.StructType):
        self.dsn, self.query, self.rows, self.schema = dsn, query, rows, schema
        self.names = [f.name for f in schema if f.name != OFFSET]
        if key not in self.names:
            raise QueryError(f"key {key!r} is no column of the query: {self.names}")
        self.key = _quoted(key)
        self.order = ", ".join([self.key, *map(_quoted, self.names)])
        self.where: list[tuple[str, list[Any]]] = []

    def sql(self, f: api.Filter, even: set[str]) -> tuple[str, list[Any]] | None:
        if isinstance(f, api.Not):
            inner = self.sql(f.child, even)
            return None if inner is None else (f"NOT ({inner[0]})", inner[1])
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if name not in even:
            return None
        column = _quoted(name)
        if isinstance(f, api.IsNull | api.IsNotNull):
            return f"{column} IS {'NOT ' * isinstance(f, api.IsNotNull)}NULL", []
        plain = lambda v: isinstance(v, int | float | str) and not isinstance(v, bool) and v == v
        if isinstance(f, api.In) and all(map(plain, f.value)):
            return f"{column} IN ({', '.join('?' * len(f.value))})", list(f.value)
        if type(f) in _COMPARE and plain(f.value):
            return f"{column} {_COMPARE[type(f)]} ?", [f.value]
        return None

    def partitions(self) -> list[Range]:
        places = f"SELECT {self.key} AS k, row_number() OVER (ORDER BY {self.order}) - 1 AS r, rank() OVER (ORDER BY {self.key}) - 1 AS f FROM ({self.query})"
        _, found = _asked(self.dsn, f"SELECT r, k, f FROM ({places}) WHERE r % {int(self.rows)} = 0 ORDER BY r")  # a row per partition
        if not found:
            return [Range(0, None, None, 0, None)]
        after = [*found[1:], (None, None, None)]
        return [Range(r, end, k, base, high) for (r, k, base), (end, high, _) in zip(found, after, strict=True)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        near, params = [], []
        if part.low is not None:
            near, params = [f"{self.key} >= ?"], [part.low]
        if part.last is not None and part.high is None:
            near.append(f"{self.key} IS NULL")
        elif part.last is not None:
            near.append(f"({self.key} <= ? OR {self.key} IS NULL)" if part.low is None else f"{self.key} <= ?")
            params.append(part.high)
        inner = f"SELECT *, row_number() OVER (ORDER BY {self.order}) - 1 + {part.base} AS {OFFSET} FROM ({self.query}) WHERE {' AND '.join(near) or '1'}"
        own = [(f"{OFFSET} >= ?", [part.first])] + ([(f"{OFFSET} < ?", [part.last])] if part.last is not None else [])
        every = own + self.where
        for _, more in every:
            params += more
        wanted = ", ".join(_quoted(f.name) for f in self.schema)
        con = connect(self.dsn)
        try:
            cursor = con.execute(f"SELECT {wanted} FROM ({inner}) WHERE {' AND '.join(f'({sql})' for sql, _ in every)} ORDER BY {OFFSET}", params)
            while rows := cursor.fetchmany(10_000):
                arrays = [pa.array([_value(r[i], f.dataType) for r in rows], _ARROW[f.dataType]) for i, f in enumerate(self.schema)]
                yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)
        finally:
            con.close()


class PushedReader(Reader):
    def pushFilters(self, filters: list[api.Filter]) -> Iterable[api.Filter]:  # noqa: N802
        even = pure(self.dsn, self.query, self.names) | {OFFSET}
        for f in filters:
            made = self.sql(f, even)
            if made is None:
                yield f
            else:
                self.where.append(made)


def _value(v: Any, kind: T.DataType) -> Any:
    if v is None or not isinstance(kind, T.StringType) or isinstance(v, str):
        return float(v) if v is not None and isinstance(kind, T.DoubleType) else v
    return v.hex() if isinstance(v, bytes) else repr(v)


class Rows(api.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        found = columns(self.options["dsn"], self.options["query"])
        return T.StructType([T.StructField(OFFSET, T.LongType()), *(T.StructField(n, k) for n, k in found.items())])

    def reader(self, schema: T.StructType) -> Reader:
        o = self.options
        return self.made(o["dsn"], o["query"], o["key"], int(o.get("rows", ROWS)), schema)

    made = Reader


class PushedRows(Rows):
    @classmethod
    def name(cls) -> str:
        return PUSHED

    made = PushedReader


def rows(spark: SparkSession, dsn: str, query: str, key: str, size: int = ROWS, pushed: bool = False) -> DataFrame:
    """The query's rows with their places; ``pushed`` gives a frame for one query, whose filters the database gets."""
    if key not in columns(dsn, query):
        raise QueryError(f"key {key!r} is no column of the query")
    spark.dataSource.register(PushedRows if pushed else Rows)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # asked for by sources that push filters
    return spark.read.format(PUSHED if pushed else NAME).options(dsn=dsn, query=query, key=key, rows=size).load()


def export(df: DataFrame, path: str, table: str) -> str:
    """Write a frame as a table of a new SQLite file on a file system that all tasks share; its DSN.

    A SQLite file has one writer, so one task writes all rows.
    """
    local = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")
    if "://" in local:
        raise QueryError(f"SQLite needs a file system that is mounted, not {path!r}")
    names = ", ".join(_quoted(c) for c in df.columns)
    marks = ", ".join("?" * len(df.columns))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.makedirs(os.path.dirname(local), exist_ok=True)
        half = f"{local}.{os.getpid()}"
        con = sqlite3.connect(half)
        try:
            con.execute(f"CREATE TABLE {_quoted(table)} ({names})")
            n = 0
            for batch in batches:
                con.executemany(f"INSERT INTO {_quoted(table)} VALUES ({marks})", zip(*(c.to_pylist() for c in batch.columns), strict=True))
                n += len(batch)
            con.commit()
        finally:
            con.close()
        os.replace(half, local)  # a task that runs again leaves the same file
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    df.coalesce(1).mapInArrow(write, "n long").collect()
    return f"sqlite://{local}"
