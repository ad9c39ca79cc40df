"""Extension: cleaning as a stream of raw JSON records.

The tests and scrubbing are those of the batch plan.  Duplicates are dropped by
hash within a watermark, so which copy stays depends on arrival, not on ``seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import hash_struct
from ..operators.clean import map_jsonl, tested


def read(spark: SparkSession, path: str) -> DataFrame:
    """A stream of JSON lines from files that arrive in ``path``."""
    return spark.readStream.option("lineSep", "\n").format("text").load(path).withColumnRenamed("value", "raw").withColumn("arrived", F.current_timestamp())


def clean(stream: DataFrame, delay: str = "1 hour", **limits) -> DataFrame:
    """Passing records, once each: (arrived, conversation, content_hash)."""
    mapped = stream.withColumn("_m", map_jsonl(F.col("raw"))).withColumns({"mappable": F.col("_m.mappable"), "conversation": F.col("_m.conversation")})
    passed = tested(mapped, **limits).where("drop_reason is null")
    hashed = passed.select("arrived", "conversation", hash_struct(F.col("conversation")).alias("content_hash"))
    return hashed.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["content_hash"])


def reasons(stream: DataFrame, window: str = "10 minutes", delay: str = "1 hour", **limits) -> DataFrame:
    """Drops by reason in tumbling windows of arrival."""
    mapped = stream.withColumn("_m", map_jsonl(F.col("raw"))).withColumns({"mappable": F.col("_m.mappable"), "conversation": F.col("_m.conversation")})
    flagged = tested(mapped, **limits).where("drop_reason is not null").withWatermark("arrived", delay)
    return flagged.groupBy(F.window("arrived", window), "drop_reason").agg(F.count("*").alias("n"))
