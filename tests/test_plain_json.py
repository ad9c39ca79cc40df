"""Canonical JSON written by the JVM against Python's, and publishing by several writers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from siltworks.functions import hashing
from siltworks.sources import files, readers, tiers


def value(rng, depth=0):
    kind = rng.randrange(10 if depth < 3 else 7)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.choice([0, -1, 7, 2**31, -(2**63), 2**63 - 1, 2**63, 10**25, 10**40])
    if kind == 2:
        return rng.choice([0.5, -0.0, 1e300, 1e-7, 3.14, 1e16])
    if kind < 7:
        return "".join(rng.choice(["a", "B", "é", "\U0001f600", '"', "\\", "/", "\n", "\t", "\r", "\b", "\f", "\x01", "\x1f", "\x7f", " ", "\x80", " ", "ﬀ", "\ud800"]) for _ in range(rng.randint(0, 6)))
    if kind == 7:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {value(rng, 3) if rng.random() < 0.1 and isinstance(k := value(rng, 3), str) else rng.choice(["a", "b", "B", "é", "z", "", "a b", "\U0001f600", "ﬀ", "k.l", "$", "'"]): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def texts():
    rng = random.Random(8)
    out = ["", "{}", " {} ", "{}x", "[1]", "1", "null", '"x"', '{"a":1,"a":2}', '{"a":NaN}', '{"a":Infinity}', '{"a":01}', '{"a":1,}', "{'a':1}", '{"a":\t1}\r', '﻿{"a":1}', "{", '{"a":"\t"}', '{"a":1}{"b":2}', '{"a":1} // x', '{"a":-0}', '{"a":1e2}', '{"a":tru}', '{"\\u0061":1}', "{" * 2000]
    for _ in range(3000):
        text = json.dumps(value(rng), ensure_ascii=rng.random() < 0.3, separators=rng.choice([(",", ":"), (", ", ": ")]))
        if rng.random() < 0.1:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(['"', "}", ",", " ", "\x00"]) + text[at:]
        out.append(text)
    return [t for t in out if "\ud800" not in t]


def python(text):
    try:
        return hashing.canonical(text) if isinstance(json.loads(text), dict) else None
    except (ValueError, RecursionError):
        return None


def test_jvm_writes_what_python_writes(spark):
    every = texts()
    got = spark.createDataFrame([(t,) for t in every], "t string").select("t", hashing.plain_json(F.col("t")).alias("j")).collect()
    mine = [r for r in got if r["j"] is not None]
    assert [(r["t"], r["j"]) for r in mine] == [(r["t"], python(r["t"])) for r in mine]
    plain = [t for t in every if python(t) is not None and "\\u" not in t and "." not in t and "e" not in t.replace("true", "").replace("false", "")]
    assert len(mine) > 0.5 * len(plain) > 100  # and it writes most of what it can


def test_lines_of_all_kinds(spark, tmp_path):
    every = [t for t in texts() if "\n" not in t and t]
    data = [t.encode() for t in every] + [b'{"a":"\xff"}', b"\xff"]
    path = tmp_path / "x.jsonl"
    path.write_bytes(b"\n".join(data) + b"\n")
    rows = readers.read_jsonl(spark, readers.Source("jsonl", str(path))).orderBy("n").collect()
    want = [python(t.removeprefix("﻿") if i == 0 else t) for i, t in enumerate(every)] + [None, None]
    assert [r["n"] for r in rows] == list(range(1, len(data) + 1))
    assert [r["raw"] for r in rows] == want
    assert all((r["raw"] is None) == (r["error"] is not None) for r in rows)


def test_one_of_two_writers_commits(spark, tmp_path):
    rows = spark.range(25).select(F.col("id").alias("seq"), F.lit("x").alias("v"))
    made = tiers.write_tier(rows, str(tmp_path), "bronze", "run-20240101-000000-abcdef", "ingest", None, {}, (), 25, 4)
    assert len(made["files"]) == 7
    with pytest.raises(files.Conflict):
        files.write_new_json(spark, tiers.manifest_uri(str(tmp_path), "bronze", "run-20240101-000000-abcdef"), {})
    (tmp_path / "a").write_text("a")
    (tmp_path / "b").write_text("b")
    with pytest.raises(files.Conflict):
        files.rename_all(spark, [(f"{tmp_path}/a", f"{tmp_path}/b")])
    assert (tmp_path / "b").read_text() == "b"


def test_many_shards_are_moved_at_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2000):
        (tmp_path / "in" / str(i)).write_text(str(i))
    files.rename_all(spark, [(f"{tmp_path}/in/{i}", f"{tmp_path}/out/{i:05d}") for i in range(2000)])
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == [f"{i:05d}" for i in range(2000)]
    files.rename_all(spark, [])
