"""Small-file operations on any Hadoop file system."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return bool(fs.exists(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _fs(spark, old)
    target = _fs(spark, new)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {old} to {new}")


class Conflict(RuntimeError):
    """Another writer was there first."""


def rename_all(spark: SparkSession, pairs: list[tuple[str, str]], at_once: int = 32) -> None:
    """Rename many files, ``at_once`` at a time, as each waits for the store; a target that exists is a conflict."""
    if not pairs:
        return
    fs = _fs(spark, pairs[0][0])[0]
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for parent in {new.rsplit("/", 1)[0] for _, new in pairs}:
        fs.mkdirs(made(parent))

    def move(pair: tuple[str, str]) -> None:
        old, new = made(pair[0]), made(pair[1])
        if fs.exists(new) or not fs.rename(old, new):
            raise Conflict(f"cannot move {pair[0]} to {pair[1]}")

    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(move, p) for p in pairs]:
            done.result()


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; empty if there is none."""
    fs, target = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    if not exists(spark, path):
        return None
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_new_json(spark: SparkSession, path: str, value: Any) -> None:
    """Write JSON to a place where nothing is; of several writers one succeeds."""
    fs, target = _fs(spark, path)
    try:
        out = fs.create(target, False)
    except Exception as e:
        if fs.exists(target):
            raise Conflict(f"{path} is there already") from e
        raise
    try:
        out.write(bytearray((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode()))
    finally:
        out.close()


def write_document(df: DataFrame, path: str) -> None:
    """The texts of ``value``, in the order of the other columns, as one file.

    The rows are sorted over all executors; one task of an executor writes them through,
    and none comes to the driver.
    """
    spark, order = df.sparkSession, [c for c in df.columns if c != "value"]
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    df.orderBy(*order).select("value").coalesce(1).write.option("lineSep", "\n").text(staging)
    (part,) = [n for n in listing(spark, staging) if n.startswith("part-")]
    delete(spark, path)
    rename(spark, f"{staging}/{part}", path)
    delete(spark, staging)


def read_json(spark: SparkSession, path: str) -> Any | None:
    data = read_bytes(spark, path)
    return None if data is None else json.loads(data)


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_bytes(spark, path, (json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())


def copy_tree(spark: SparkSession, source: str, target: str) -> None:
    """Mirror a folder, to or from the local file system."""
    fs, old = _fs(spark, source)
    new_fs, new = _fs(spark, target)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, old, new_fs, new, False, True, spark.sparkContext._jsc.hadoopConfiguration())
