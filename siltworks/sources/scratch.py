"""Tables written to the cluster's shared folder to cut lineage.

``spark.checkpoint.dir`` names the folder; it is read from the session and is
set here only when nothing has set it, on a single machine (tests, local runs).
A written table survives the loss of any executor, unlike a persisted or
locally checkpointed one.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = "spark.checkpoint.dir"
#: Bytes read for each file of a table at least.
FILE_BYTES = 16 << 20
#: Short rows that are broadcast at most (some 30 MB).
BROADCAST_ROWS = 500_000
#: Only for paths on a local file system.
_PLAIN = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_scope: list[list[str]] = []


def folder(spark: SparkSession) -> str:
    """The shared folder; a local one if the session names none and has no cluster."""
    found = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY, None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {KEY} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="siltworks-")
        spark.conf.set(KEY, found)
    return found.rstrip("/")


def path(spark: SparkSession, name: str) -> str:
    """A place for a new table or file; it is noted for ``delete`` like tables are."""
    made = f"{folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _scope:
        _scope[-1].append(made)
    return made


def small(df: DataFrame, rows: int) -> DataFrame:
    """A table for a join: broadcast up to ``BROADCAST_ROWS`` rows, and shuffled beyond."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def read_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that ``df`` is made from; None if that cannot be told."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(s >= 1 << 60 for s in sizes) else sum(sizes)


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Small tables get few files: one for each ``FILE_BYTES`` that are read; where that is less
    than two for each core, one for each eighth of that, up to those two.
    Creating a file is dear on a local file system, where Hadoop starts a process to set
    its permissions and those of its checksum file; the latter is left out.
    """
    spark, place = df.sparkSession, path(df.sparkSession, name)
    size = read_bytes(df)
    if size is not None:
        some = max(1, min(2 * spark.sparkContext.defaultParallelism, -(-8 * size // FILE_BYTES)))
        df = df.coalesce(max(some, -(-size // FILE_BYTES)))
    df.write.options(**_PLAIN).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


@contextlib.contextmanager
def collected(paths: list[str]) -> Iterator[None]:
    """Tables written inside are noted in ``paths``, for ``delete`` later."""
    _scope.append(paths)
    try:
        yield
    finally:
        _scope.pop()


def tidied(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Writes the result of ``f(df, ...)``, which must be narrow, and deletes the tables it was made from."""

    @wraps(f)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        held: list[str] = []
        with collected(held):
            made = f(df, *args, **kwargs)
        result = table(made, f.__name__)
        delete(df.sparkSession, held)
        return result

    return run


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables once every result built on them has been written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        target = jvm.org.apache.hadoop.fs.Path(paths.pop())
        target.getFileSystem(conf).delete(target, True)
