"""Estimation of labelers where kinds hold true and false candidates."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.llm import pii


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def number(rng, good):
    while True:
        d = rng.choice("456789") + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn(d) == good:
            return d


def spans(spark, texts):
    out = pii.detect(frame(spark, texts)).select("doc_id", F.explode("spans").alias("x")).select("doc_id", "x.*").collect()
    found = {}
    for r in out:
        found.setdefault(r["doc_id"], set()).add((r["kind"], r["s"], r["e"]))
    return found


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_numbers_that_fail_their_check_are_refused(spark, share):
    """However many of the numbers are no cards, they do not become spans, nor does their form count as proof."""
    rng = random.Random(int(share * 10))
    bad = [rng.random() < share for _ in range(300)]
    texts = [f"some words {number(rng, not b)} and more" for b in bad] + [f"card: {number(rng, True)}" for _ in range(20)]
    found = spans(spark, texts)
    assert all((i in found) != b for i, b in enumerate(bad))
    assert all(300 + i in found for i in range(20))


def test_the_form_labeler_is_found_out(spark):
    rng = random.Random(2)
    texts = [f"words {number(rng, rng.random() < 0.5)} here" for _ in range(400)]
    c = pii.find(frame(spark, texts)).select(F.explode("candidates").alias("c"))
    rows = c.groupBy("c.kind", *[f"c.{v}" for v in (*pii.VOTES, *pii.FEATURES)]).agg(F.count("*").alias("n")).collect()
    _, right = pii.estimate(sorted(rows))
    assert right["card", 0] < 0.65  # it votes for every number
    assert right["card", pii.LABELERS.index("check")] == 0.995


def test_digests_are_told_from_keys(spark):
    """The same strings after words of either kind: what the words around say decides."""
    rng = random.Random(3)
    hexa = lambda: "a1" + "".join(rng.choice("0123456789abcdef") for _ in range(38))
    keys = [f'token = "{hexa()}" in the file' for _ in range(150)]
    digests = [f"the checksum {hexa()} of the file" for _ in range(100)] + [f"commit {hexa()} was merged" for _ in range(50)]
    found = spans(spark, keys + digests)
    assert sum(i in found for i in range(150)) >= 0.9 * 150
    assert sum(150 + i in found for i in range(150)) <= 0.1 * 150


def test_planted_data_of_the_tables(spark):
    """On the test tables: cards without a valid check digit are refused; what was planted is found, kind by kind."""
    path = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.1/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(path).select("doc_id", "text")
    got = pii.detect(docs).select("doc_id", "text", F.explode("spans").alias("x")).select("doc_id", "x.kind", F.expr("substring(text, x.s + 1, x.e - x.s)").alias("m")).collect()
    kinds = {}
    for r in got:
        kinds.setdefault(r["kind"], []).append((r["doc_id"], r["m"]))
    assert all(luhn(re.sub(r"\D", "", m)) for _, m in kinds["card"])
    planted = {"email": r"[\w.]+@mail\d\.example\.com", "card": r"(?<!\d)\d{16}(?!\d)", "phone": r"\+1 \(\d{3}\) 555-\d{4}", "secret": r'(?<=token = ")[0-9a-f]{40}(?=")', "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.])"}
    refused = 0
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    for kind, pattern in planted.items():
        want = {(i, m[0]) for i, t in texts for m in re.finditer(pattern, t)}
        if kind == "card":
            refused = sum(not luhn(m) for _, m in want)
            want = {(i, m) for i, m in want if luhn(m)}
        assert len(want) > 100 and len(want & set(kinds[kind])) >= 0.95 * len(want), kind
    assert refused > 100
