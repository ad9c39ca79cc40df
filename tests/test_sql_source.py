"""The database source: places, ties, partitions, pushed filters, errors."""

import json
import sqlite3

import pytest
from pyspark.sql import datasource as api, types as T

from siltworks import config as cfg
from siltworks.plans import pipeline
from siltworks.sources import readers, sql_source, tiers


@pytest.fixture
def database(tmp_path):
    path = tmp_path / "x.db"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE t (k, name, v, mixed, raw)")
    rows = [(None, "n1", 1.5, 1, b"\x01"), (None, None, None, None, None)]
    rows += [(3, f"hot {i}", i / 2, "text" if i % 2 else i, b"ab") for i in range(120)]  # most rows share a key
    rows += [(i, "it's", 7, 2.5, None) for i in range(10)]
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", rows)
    con.commit()
    con.close()
    return f"sqlite://{path}", rows


def sort_key(row):
    return tuple((x is not None, isinstance(x, str | bytes), x if x is not None else 0) for x in (row[0], *row))


def test_places_are_those_of_the_whole_order(spark, database):
    dsn, rows = database
    want = sorted(rows, key=sort_key)
    for size in (7, 1000):
        found = sql_source.rows(spark, dsn, "SELECT * FROM t", "k", size)
        assert dict(found.dtypes) == {"_offset": "bigint", "k": "bigint", "name": "string", "v": "double", "mixed": "string", "raw": "binary"}
        assert found.rdd.getNumPartitions() == -(-len(rows) // size)
        got = sorted(found.collect(), key=lambda r: r["_offset"])
        assert [r["_offset"] for r in got] == list(range(len(rows)))
        assert [(r["k"], r["name"], r["v"]) for r in got] == [r[:3] for r in want]
        sizes = found.rdd.glom().map(len).collect()
        assert max(sizes) <= size  # rows that share a key are split


def test_filters_keep_the_places(spark, database):
    dsn, rows = database
    found = sql_source.rows(spark, dsn, "SELECT * FROM t", "k", 40)
    every = found.collect()
    for condition, keep in (
        ("k = 3 AND v > 4.25", lambda r: r["k"] == 3 and r["v"] is not None and r["v"] > 4.25),
        ("name = 'it''s' OR k IS NULL", lambda r: r["name"] == "it's" or r["k"] is None),
        ("NOT (name = 'hot 5')", lambda r: r["name"] is not None and r["name"] != "hot 5"),
        ("mixed = '2.5'", lambda r: r["mixed"] == "2.5"),
        ("k IN (1, 2) AND name IS NOT NULL", lambda r: r["k"] in (1, 2) and r["name"] is not None),
        ("_offset BETWEEN 20 AND 60", lambda r: 20 <= r["_offset"] <= 60),
    ):
        want = sorted(r["_offset"] for r in every if keep(r))
        for frame in (found, sql_source.rows(spark, dsn, "SELECT * FROM t", "k", 40, pushed=True)):
            assert sorted(r["_offset"] for r in frame.where(condition).collect()) == want, condition


def test_what_is_pushed(database):
    dsn, _ = database
    schema = T.StructType([T.StructField(sql_source.OFFSET, T.LongType()), *(T.StructField(n, k) for n, k in sql_source.columns(dsn, "SELECT * FROM t").items())])
    reader = sql_source.PushedReader(dsn, "SELECT * FROM t", "k", 10, schema)
    left = list(reader.pushFilters([api.GreaterThan(("k",), 1), api.EqualTo(("mixed",), "1"), api.StringStartsWith(("name",), "h"), api.EqualTo(("v",), float("nan")), api.Not(api.IsNull(("name",)))]))
    assert [type(f).__name__ for f in left] == ["EqualTo", "StringStartsWith", "EqualTo"]
    assert reader.where == [('"k" > ?', [1]), ('NOT ("name" IS NULL)', [])]


def test_empty_and_wrong_queries(spark, database):
    dsn, _ = database
    assert sql_source.rows(spark, dsn, "SELECT * FROM t WHERE k > 99", "k").count() == 0
    for query, key, base in (("SELECT nothing FROM t", "k", dsn), ("SELECT * FROM t", "none", dsn), ("SELECT k, 1 AS _Offset FROM t", "k", dsn), ("SELECT 1 AS k", "k", "sqlite:///none/such.db"), ("SELECT 1 AS k", "k", "other://x")):
        with pytest.raises(sql_source.QueryError):
            sql_source.rows(spark, base, query, key)


def test_ingestion_from_a_query(spark, database, tmp_path, monkeypatch):
    dsn, rows = database
    raw = {"model": {"adapter": "word"}, "ingest": {"sources": [{"type": "sql", "uri": "SELECT k, name AS q, mixed AS a FROM t", "key": "k", "mapping": {"prompt_column": "q", "response_column": "a"}}]}}
    run = "run-20240101-000000-abcdef"
    monkeypatch.delenv("SILTWORKS_SQL_DSN", raising=False)
    with pytest.raises(readers.SourceError, match="DSN"):
        pipeline.ingest(spark, cfg.parse(raw), str(tmp_path / "tiers"), run)
    monkeypatch.setenv("SILTWORKS_SQL_DSN", dsn)
    made = pipeline.ingest(spark, cfg.parse(raw), str(tmp_path / "tiers"), run)
    assert made["counts"]["read"] == len(rows)
    found = tiers.read_tier(spark, str(tmp_path / "tiers"), "bronze", run).orderBy("seq").collect()
    assert [r["source"]["locator"] for r in found] == [f"offset:{i}" for i in range(len(rows))]
    assert json.loads(found[-1]["raw"]) == {"k": 9, "q": "it's", "a": "2.5"}
    raw["ingest"]["sources"][0]["mapping"]["prompt_column"] = "none"
    with pytest.raises(readers.SourceError, match="none"):
        pipeline.ingest(spark, cfg.parse(raw), str(tmp_path / "tiers"), run)


def test_export_refuses_what_is_not_mounted(spark):
    with pytest.raises(sql_source.QueryError, match="mounted"):
        sql_source.export(spark.range(1), "hdfs://host/x.db", "t")
