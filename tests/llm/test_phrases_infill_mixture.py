"""Collocations, fill-in-the-middle and source mixing against brute force and on odd inputs."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import infill, mixture, phrases, queries

DOCS = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least, most, inside):
    """Collocations of (lang, text) rows, straight from the definition."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in cands.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:most], 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_by_definition(spark, seed):
    rng = random.Random(seed)
    word = ["the", "The", "é", "É", "a-b", "x", "new", "york", "<P>", "ab c", "zz"]
    rows = [(None, None), ("en", ""), ("en", " \t "), ("", "one two"), (None, "new york, new york"), ("en", "x" * 70_000), ("de", "a\x00b c a\x00b c")]
    for _ in range(120):
        text = "".join(rng.choice(word) + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "]) for _ in range(rng.randint(1, 60)))
        rows += [(rng.choice(["en", "de", None]), text)] * rng.choice([1, 1, 3])
    rows += [("en", "log line of a form\n" * 400)]
    df = spark.createDataFrame([(lang, text, "p", 1) for lang, text in rows], "lang string, text string, phrase string, f int")
    for least, most, inside in ((5, 2000, 80), (8, 12, 50)):
        got = sorted(tuple(r) for r in phrases.mine(df, least=least, most=most, inside=inside).collect())
        assert got == mined(rows, least, most, inside)


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None)], [("en", "a b c")]):
        assert phrases.mine(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_scores_pass_64_bits(spark):
    big = 6 * 10**12
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 1)]
    r = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, m int, f long")).first()
    assert r["score"] == 2_000_000 * (big - 1) // (2 * big + 7)


def test_summing_tells_equal_keys_apart():
    """N-grams that meet under one key are summed only when their bytes agree."""
    import pyarrow as pa

    held = phrases.Gathered(3)
    data = np.frombuffer(b"ab cd ab", np.uint8)
    at = np.array([0, 3, 6])
    list(held.add(data, pa.array(["x"]), np.zeros(3, int), at, at + 2, np.array([1, 1, 1]), np.full(3, 5, np.uint64)))
    (batch,) = held.flush()
    got = collections.Counter()
    for blob in batch.column("blob"):
        for r in pa.ipc.read_record_batch(blob.as_buffer(), phrases._ENTRY).to_pylist():
            got[r["phrase"]] += r["w"]
    assert got == {b"ab": 2, b"cd": 1}


def filled(doc, text):
    text = text or ""
    w = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(w), "plain", None, None, text
    i, j = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = ("".join(x) for x in (w[:i], w[i:j], w[j:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    return len(w), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_infill_by_definition(spark):
    rng = random.Random(3)
    part = [" ", "\n", "\t\r\n", "a", "word", "é", "\U0001f600", "<P", "<", "P>", "<S>", " ", " ", "<S", "\x00"]
    rows = [(None, "no id at all"), (1, None), (2, ""), (3, "   "), (4, "x" * 300_000), (5, "a b " * 30_000), (6, "<"), (7, "<P")]
    rows += [(i, "".join(rng.choice(part) for _ in range(rng.randint(1, 40)))) for i in range(10, 400)]
    rows += rows[:20]
    df = spark.createDataFrame([(i, t, "keep", "mine") for i, t in rows], "doc_id long, text string, _draw0 string, output string")
    got = infill.transform(df).withColumn("back", infill.restored()).collect()
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert [(r["n_tokens"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got] == [filled(i, t) for i, t in rows]
    assert [r["back"] for r in got] == [t or "" for _, t in rows]
    assert all(r["_draw0"] == "keep" for r in got)
    assert infill.transform(df.limit(0)).count() == 0


def mixed(rows, weights=(5, 2, 1), most=3):
    """(targets by source, copies by row) with exact shares and sorted running sums."""
    from fractions import Fraction

    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sums = collections.Counter()
    for (_, _, s), z in zip(rows, size, strict=True):
        sums[s] += z
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = Fraction(sum(size)), set(order), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sums[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = Fraction(most * sums[s])
            left -= target[s]
        open_ -= full
    below = {}
    base = {s: int(target[s]) // sums[s] if sums[s] else 0 for s in order}
    draw = lambda d, t: int(hashlib.md5(f"mix:{d if d is not None else '' if t is None else 'text:' + t}".encode()).hexdigest()[:15], 16)
    for s in order:
        per = collections.Counter()
        for (d, t, x), z in zip(rows, size, strict=True):
            if x == s and z:
                per[draw(d, t)] += z
        at, budget, below[s] = 0, int(target[s]) - base[s] * sums[s], 0
        for h in sorted(per):
            if at + per[h] > budget and 2 * at + per[h] >= 2 * budget:
                break
            at, below[s] = at + per[h], h + 1
    return sums, target, [base[s] + (z > 0 and draw(d, t) < below[s]) for (d, t, s), z in zip(rows, size, strict=True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_by_definition(spark, seed, monkeypatch):
    rng = random.Random(seed)
    names = ["hot"] * 40 + ["a", "Z", "é", "", None, "tiny"] + [f"s{i}" for i in range(8)]
    rows = [(i, None if rng.random() < 0.05 else "w " * rng.choice([0, 1, 5, 30, 400]), rng.choice(names)) for i in range(500)]
    rows += [(None, "no id", "a"), (None, None, "b"), (9000, "", "empty"), *rows[:15], (9001, "w " * 20_000, "hot"), (9002, "w", "tiny2")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, source string, size int, _hash string")
    for bound in (mixture.BROADCAST_SOURCES, 0)[-seed:]:  # thresholds broadcast, then joined by shuffle
        monkeypatch.setattr(mixture, "BROADCAST_SOURCES", bound)
        sums, target, copies = mixed(rows)
        got = mixture.mix(df).collect()
        want = sorted((str(d), str(t), str(s), c, sums[s], f"{float(target[s]):.9g}") for (d, t, s), c in zip(rows, copies, strict=True))
        assert sorted((str(r["doc_id"]), str(r["text"]), str(r["source"]), r["copies"], r["source_size"], f"{r['target']:.9g}") for r in got) == want
    taken = collections.Counter()
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
    largest = collections.Counter()
    for r in got:
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sums)
    assert mixture.repeated(mixture.mix(df)).count() == sum(copies)


def test_mix_is_nested(spark):
    """What a smaller budget takes, a larger one takes as well."""
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 200, "x").otherwise("y").alias("source"))
    taken = [{r["doc_id"] for r in mixture.mix(df, weights=w).collect() if r["copies"] and r["source"] == "y"} for w in ((5, 1), (5, 3))]
    assert taken[0] < taken[1]


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixture.mix(empty).count() == 0
    one = mixture.mix(spark.createDataFrame([(1, None, "en", "s")], DOCS)).first()
    assert (one["size"], one["source_size"], one["target"], one["copies"]) == (0, 0, 0.0, 0)
    with pytest.raises(ValueError, match="weights"):
        mixture.mix(empty, weights=())


@pytest.mark.parametrize("name", ["op11_collocations", "op12_fill_in_middle", "op13_mixture"])
def test_query_equals_sql(name, against_sql):
    against_sql(queries.QUERIES[name], queries.SQL[name])
