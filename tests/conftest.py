import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(value):
    """Rows and nested values as comparable text; floats to nine digits."""
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return str({k: plain(v) for k, v in sorted(value.items())})
    if isinstance(value, list | tuple):
        return str([plain(v) for v in value])
    return str(value)


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compares a query with its SQL on a scale factor's tables."""
    import duckdb

    base = os.environ.get("TESTDATA", "/root/testdata")

    def compare(query, sql, sf="sf0.001"):
        folder = f"{base}/{sf}"
        if not os.path.isdir(folder):
            pytest.skip("no test tables here")
        con = duckdb.connect()
        for name in os.listdir(folder):
            con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{folder}/{name}'")
        frame = query(spark, folder)
        columns = sorted(frame.columns)
        ours = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
        cursor = con.execute(sql)
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
        assert ours == theirs

    return compare
