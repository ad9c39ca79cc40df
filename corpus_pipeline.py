"""The corpus pipeline: stages over ``documents``, each written and read again.

Stages: documents failing the quality rules go; near-copied lines go, and
documents of which nothing is left; of each group of near copies the document
with the least id stays; documents holding benchmark passages go; the rest is
encoded.  All but the last return the columns of ``documents``, further ones of
any name included, with ``n_chars`` made anew where lines went.

Null and empty texts fail the quality rules.  Null languages and sources are
groups of their own there.  Rows with one id are one document: near copies keep
or drop them together, and repeated rows all stay.  Rows without an id pass the
stages on lines and near copies unchanged, as there is nothing to name them by.
Ties do not occur: the least id and the first place of a line are unique, but
for repeated rows.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltworks.llm import batches, bpe, contamination, jaccard, line_dedup, quality_rules, queries, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Ids of dropped documents that are broadcast at most, some 30 MB.
BROADCAST_IDS = 500_000
#: Scratch tables of the stage before, whose result is written when the next one starts.
_earlier: list[str] = []


def stage(f: Stage) -> Stage:
    """Clears the scratch tables of the stage before and notes those of this one."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scratch.delete(spark, _earlier)
        batches.release()
        with scratch.collected(_earlier):
            return f(spark, docs, sf_dir)

    return run_stage


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same columns under names that clash with no operator's, and these names."""
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    return plain, dict(zip(docs.columns, plain.columns, strict=True))


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, at = numbered(docs)
    judged = quality_rules.apply(plain, at["text"], at["lang"], at["source"])
    return judged.where("kept").select(*plain.columns).toDF(*docs.columns)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard.join(docs.select("doc_id", "text"))
    gone = scratch.table(found.where("doc_id != component_id").select("doc_id").distinct(), "pipeline-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, at = numbered(docs)
    found = contamination.scan(plain, queries.read(spark, sf_dir, "benchmark"), text=at["text"])
    return found.where("n_hit = 0").select(*plain.columns).toDF(*docs.columns)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.bpe_digests(bpe.encode(docs.select("doc_id", "text"), queries.vocabulary(), packed=True, decoded=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: The tokenizer can't be expressed in SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is a table in the shared folder,
    which goes once the next one is written."""
    docs = queries.read(spark, sf_dir, "documents")
    last: list[str] = []
    for name, f in STAGES:
        made: list[str] = []
        result = f(spark, docs, sf_dir)
        with scratch.collected(made):
            docs = scratch.table(result, f"pipeline-{name}")
        scratch.delete(spark, last)
        last = made
    scratch.delete(spark, _earlier)
    return docs
