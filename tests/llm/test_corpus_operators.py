"""Jaccard join, line dedup, language model, union-find and the pipeline against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import bitmap, cells, graph, jaccard, kneser_ney, line_dedup, packed, prefix_tree, queries, scratch, textvec as tv

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def classes(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100, 100 + i) for i in range(1, 80)] + [(i, i + 1) for i in range(200, 240)] + [(7, 7)]
    want = classes({n for e in edges for n in e}, edges)
    linked = {n for e in edges if e[0] != e[1] for n in e}
    for chunk in (graph.CHUNK, 25):  # one chunk, then star rounds over several
        links = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
        found = {r["node"]: r["component"] for r in graph.components(links, chunk).collect()}
        assert found == {n: want[n] for n in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def corpus(rng, n, edit):
    """Families of near copies over shared passages, exact copies and odd texts."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(25))
    texts = [None, "", "  \n", "one", "One", "two words", "É é", "x " * 30, "x " * 300]
    for _ in range(n):
        base = [word() for _ in range(rng.randint(3, 120))]
        if rng.random() < 0.3:
            base = passage.split() + base[: rng.randint(1, 12)]
        for _ in range(rng.choice([1, 1, 2, 3, 30])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, int(len(own) * edit)))):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))
        texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("seed,edit", [(1, 0.02), (2, 0.05), (3, 0.03)])
def test_jaccard_join_is_exact(spark, seed, edit):
    texts = corpus(random.Random(seed), 25, edit)
    rows = list(enumerate(texts))
    random.Random(seed).shuffle(rows)
    sets = {i: shingle_set(t) for i, t in rows}
    by = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by[g].append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(frame(spark, rows).repartition(6)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


@pytest.mark.parametrize("light", [jaccard.LIGHT, 2])
def test_jaccard_join_of_a_hot_passage(spark, monkeypatch, light):
    """Many texts of one passage and a few own words, over split n-grams and small cells."""
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "SPLIT", 10)
    monkeypatch.setattr(jaccard, "TREE", 16)
    monkeypatch.setattr(cells, "BLOCK", 16)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join(passage + [word() for _ in range(rng.randint(0, 16))])) for i in range(150)]
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    assert len(set(want.values())) > 1
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(frame(spark, rows).repartition(5)).collect()}
    assert got == want


def test_bitmap_finds_every_key(spark):
    keys = [0, 1, -1, 2**40 + 5, -(2**63), 2**63 - 1, 32768, 32767, (1 << bitmap.BITS) - 1, 1 << bitmap.BITS]
    table = bitmap.build(spark.createDataFrame([(k,) for k in keys], "k long"), "k")
    assert bitmap.passes(table, np.array(keys)).all() and bitmap.passes(table, np.arange(100_000, 200_000)).sum() < 10


def test_jaccard_join_edges(spark):
    assert jaccard.join(frame(spark, [])).count() == 0
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (3, "a b c d e f"), (9, "g h i j k l"), (None, "a b c d e f")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(frame(spark, rows).withColumn("component_id", F.lit(0)).withColumn("n", F.lit(1))).where("doc_id is not null").collect()}
    assert got == {5: 3, 3: 3, 9: 3}  # rows with one id are one document
    more = [(7, "a b c d e f"), (7, "g h i j k l"), (7, "m n o p q r"), (8, "m n o p q r"), (6, "g h i j k l"), (None, "x y z u v w"), (None, None)]
    rows = jaccard.join(frame(spark, more)).collect()
    assert len(rows) == 7 and {r["doc_id"]: r["component_id"] for r in rows} == {7: 6, 8: 6, 6: 6, None: None}
    long = " ".join(str(i) for i in range(150_000))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(frame(spark, [(1, long), (2, long + " x"), (3, long[: len(long) // 2])])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("work", [prefix_tree.WORK, 50])
def test_prefix_trees_by_brute_force(monkeypatch, work):
    monkeypatch.setattr(prefix_tree, "WORK", work)
    rng = np.random.default_rng(4)
    groups, members = [], []
    for g in range(12):
        base = rng.choice(3000, 60, replace=False).astype(np.uint64)
        for _ in range(int(rng.integers(1, 40))):
            keep = base[rng.random(60) > rng.uniform(0, 0.3)]
            members.append(np.unique(np.r_[keep, rng.choice(9000, rng.integers(0, 20)).astype(np.uint64)]))
            groups.append(g)
        members += [members[-1], np.zeros(0, np.uint64)]
        groups += [g, g]
    tree = prefix_tree.Forest(np.array(groups), np.concatenate(members), np.r_[0, np.cumsum([len(m) for m in members])], 80)
    pairs = [(i, j) for j in range(len(members)) for i in range(j) if groups[i] == groups[j]]
    similar = [(i, j) for i, j in pairs if len(members[i]) and 100 * len(np.intersect1d(members[i], members[j])) >= 80 * len(np.union1d(members[i], members[j]))]
    found = [(int(i), int(j)) for i, j in zip(*tree.links(), strict=True)]
    assert {tuple(sorted(p)) for p in found} <= set(similar)
    assert classes(range(len(members)), found) == classes(range(len(members)), similar)
    assert 0 < tree.left < tree.met


def test_prefix_trees_leave_dissimilar_sets_early():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 4000, 400).astype(np.uint64)) for _ in range(60)]
    tree = prefix_tree.Forest(np.zeros(60, np.int64), np.concatenate(sets), np.r_[0, np.cumsum([len(s) for s in sets])], 85)
    assert len(tree.row) == 60 and len(tree.links()[0]) == 0
    assert tree.left >= 1770 * 0.9 and tree.met < 1770 * 6 < 1770 * (len(tree.depth) - 1)  # of 1770 pairs most go before their paths end
    none = prefix_tree.Forest(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(1, np.int64), 80)
    assert len(none.links()[0]) == 0


def test_bitmap_bound_never_loses_a_pair(spark):
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(40):
        own = rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64)
        sets += [np.unique(own), np.unique(np.r_[own[: max(1, int(len(own) * rng.uniform(0.85, 1)))], rng.integers(0, 2**63, 3).astype(np.uint64)])]
    bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
    bits = cells.parities(np.concatenate(sets), bounds).to_pylist()
    known = spark.createDataFrame([(i, len(s), b) for i, (s, b) in enumerate(zip(sets, bits, strict=True))], "node long, n long, bits array<long>")
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    passed = {(r["a"], r["b"]) for r in cells.plausible(spark.createDataFrame(pairs, "a long, b long"), known, 80).collect()}
    similar = {(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert similar and similar <= passed and len(passed) < len(pairs) / 2


def char_set(line):
    return frozenset(line[i : i + line_dedup.K] for i in range(max(1, len(line) - line_dedup.K + 1)))


def expected_lines(rows):
    occurrences = [(i, n, x) for i, t in sorted(rows) for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    unique = list(dict.fromkeys(x for *_, x in occurrences))
    sets = [char_set(x) for x in unique]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    comp, at = classes(range(len(sets)), links), {x: k for k, x in enumerate(unique)}
    seen, gone = set(), collections.defaultdict(list)
    for i, n, x in occurrences:
        if comp[at[x]] in seen:
            gone[i].append(n)
        seen.add(comp[at[x]])
    return gone


def line_rows(rng):
    sentence = lambda: " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(8, 20)))
    pool = [sentence() for _ in range(30)]
    near = [p[:-1] + "!" for p in pool[:15]]
    rows = [(i, "\n".join(rng.choice(pool + near + ["", "  ", "ok"]) for _ in range(rng.randint(0, 6))) or None) for i in range(80)]
    return rows + [(100, "\n".join([pool[0]] * 40)), (101, ""), (102, "\n\n"), (103, pool[1] + "\r"), (104, "a" * 5000), (105, "a" * 5000)]


def test_line_dedup_by_brute_force(spark):
    rows = line_rows(random.Random(8))
    gone = expected_lines(rows)
    docs = frame(spark, rows).repartition(5).withColumns({"extra": F.lit("x"), "_doc": F.lit(1), "_dropped": F.lit(2), "line": F.lit(3)})
    for hot in (line_dedup.HOT, 2):  # then keys that two lines of a block share are split
        found = {r["doc"]: [d["number"] for d in r["dropped"]] for r in line_dedup.decisions(docs, hot=hot).collect()}
        assert {k: v for k, v in found.items() if v} == dict(gone)
    kept = {r["doc_id"]: r for r in line_dedup.dedup(docs).collect()}
    for i, t in rows:
        lines = (t or "").split("\n")
        left = "\n".join(x for n, x in enumerate(lines) if n not in gone[i])
        if gone[i] and not left.strip():
            assert i not in kept
        else:
            assert kept[i]["text"] == (left if gone[i] else t) and kept[i]["extra"] == "x"
    assert line_dedup.dedup(frame(spark, [])).count() == 0
    copied = "a line with words in it\nand another one that is longer"
    lost = frame(spark, [(None, copied), (None, None), (7, copied), (7, copied)])  # rows without an id, and a repeated row
    assert [r["text"] for r in line_dedup.dedup(lost).where("text is not null").collect()] == [copied] * 3


@pytest.mark.parametrize("block", [2048, 40])
def test_line_dedup_of_template_lines(spark, monkeypatch, block):
    monkeypatch.setattr(cells, "BLOCK", block)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    base = word(180)
    lines = []
    for _ in range(120):  # a pair differs in its last five characters, lines of the template in 25
        field = word(20)
        lines += [base + field + word(5) for _ in range(2)]
    sets = [char_set(x) for x in lines]
    near = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    far = [len(a & b) / len(a | b) for a, b in zip(sets, sets[2:], strict=False)]
    assert min(near) > 0.8 and max(far) < 0.8
    rng.shuffle(lines)
    rows = list(enumerate("\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)))
    gone = expected_lines(rows)
    assert sum(map(len, gone.values())) == 120
    for docs, hot in ((frame(spark, rows), line_dedup.HOT), (frame(spark, rows).repartition(4), 5)):
        found = {r["doc"]: [d["number"] for d in r["dropped"]] for r in line_dedup.decisions(docs, hot=hot).collect()}
        assert {k: v for k, v in found.items() if v} == dict(gone)


def test_hot_keys_are_split(spark):
    """Of a key that all lines share, a shard of keys gets a few lines of each task; the rest is dealt by line."""
    n, lines = 4, [f"an entry of the same long form with much in common, number {i:05d}, and nothing else in it" for i in range(3000)]
    docs = frame(spark, [(i, "\n".join(lines[i : i + 10])) for i in range(0, 3000, 10)]).repartition(3)
    rows = line_dedup._bands(docs, n, "text", line_dedup.HOT).collect()
    own, every, spread = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        if r["shard"] < n:
            own.update((r["shard"], int(k)) for k in np.frombuffer(r["key"], "<u4"))
        else:
            every.update(np.frombuffer(r["key"], "<u8").tolist())
            spread[r["shard"]] += len(r["line"]) // 8
    assert max(every.values()) > 1000  # of 3,000 lines
    assert all(own[k % n, k >> 32] <= 3 * 4 for k, m in every.items() if m > 1000)  # a few from each of three tasks
    assert len(spread) == n and max(spread.values()) < 2 * min(spread.values())


def test_bands_recall():
    rng, hit = random.Random(2), 0
    base = "".join(rng.choice("abcdefghij ") for _ in range(200))
    for k in range(200):
        at = rng.randrange(60, 140)
        other = base[:at] + "#" + base[at + 1 :]  # similarity of about 0.92
        keys = []
        for line in (base, other):
            lines = line_dedup.Lines(np.frombuffer(line.encode(), np.uint8), np.array([0, len(line)]))
            keys.append(line_dedup.band_keys(line_dedup.signatures(*lines.shingles(np.arange(1))))[:, 0])
        hit += bool((keys[0] == keys[1]).any())
        base = base[1:] + rng.choice("abcdefghij ")
    assert hit >= 199


def model_by_hand(docs, trusted, words):
    """Perplexities of the interpolated model, straight from its definition; tokens
    outside ``words`` are spelled by their bytes."""
    token = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\x00-\x20\x80-\U0010ffff0-9A-Za-z]+")
    fold = lambda w: w[0].lower() + w[1:] if "A" <= w[0] <= "Z" else w
    toks = {i: [fold(w) for w in token.findall(t or "")] for i, t in docs}
    known = [w for w, _ in sorted(collections.Counter(w for i in trusted for w in toks[i]).items(), key=lambda x: -x[1])][:words]
    spell = lambda ts: [s for w in ts for s in ([w] if w in known else list(w.encode()))]
    symbols = {i: spell(t) for i, t in toks.items()}
    grams = {i: collections.Counter(zip(["<s>", *t[:-1]], t, strict=False)) for i, t in symbols.items()}
    c = sum((grams[i] for i in trusted), collections.Counter())
    total, after, cont = collections.Counter(), collections.defaultdict(collections.Counter), collections.Counter()
    for (u, w), n in c.items():
        total[u] += n
        after[u][min(n, 3)] += 1
        cont[w] += 1
    d = kneser_ney._discounts(np.array([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]))
    low = kneser_ney._discounts(np.array([sum(n == k for n in cont.values()) for k in (1, 2, 3, 4)]))
    types = sum(cont.values())
    mass = sum(max(n - low[min(n, 3)], 0) for n in cont.values())

    def p(u, w, n):
        lower = max(cont[w] - low[min(cont[w], 3)], 0) / types + (1 - mass / types) / (257 + len(known))
        if not total[u]:
            return lower
        return max(n - d[min(n, 3)], 0) / total[u] + sum(d[k] * after[u][k] for k in (1, 2, 3)) / total[u] * lower

    out = {}
    for i, g in grams.items():
        cost = sum(-round(1000 * math.log(p(u, w, max(c[u, w] - n * (i in trusted), 0)))) * n for (u, w), n in g.items())
        out[i] = (cost, len(toks[i]))
    return out


def verdicts_by_hand(costs, trusted):
    """(score, limit) in thousandths, one language."""
    mean = sum(costs[i][0] for i in trusted) / sum(costs[i][1] for i in trusted)
    score = {i: round((c + kneser_ney.SHRINK * mean) / (n + kneser_ney.SHRINK)) for i, (c, n) in costs.items() if n}
    order = sorted(score[i] for i in trusted)
    at = lambda share: order[-(-share * len(order) // 100) - 1]
    return score, math.floor(at(kneser_ney.Q) + kneser_ney.SLACK * (at(kneser_ney.Q) - at(50)))


def test_language_model_by_hand(spark, monkeypatch):
    rng = random.Random(5)
    words = ["the", "cat", "sat", "on", "mat", "Dog", "ran", "é", "far"]
    say = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", ".", "!!"]) for _ in range(n))
    docs = [(i, say(rng.randint(1, 60))) for i in range(120)] + [(200, None), (201, ""), (202, "zzz qqq xxx"), (203, "the the the the"), (204, "the cat " * 20_000), (205, "x" * 50_000)]
    trusted = {i for i in range(80)}
    labels = spark.createDataFrame([(i, int(i in trusted), 0) for i in range(100)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    for hot, most, bound in ((kneser_ney.HOT, kneser_ney.WORDS, 1000), (5, kneser_ney.WORDS, 0), (50, 4, 1000)):
        monkeypatch.setattr(kneser_ney, "BROADCAST_IDS", bound)
        monkeypatch.setattr(kneser_ney, "BROADCAST_LANGS", bound)
        monkeypatch.setattr(kneser_ney, "HOT", hot)
        monkeypatch.setattr(kneser_ney, "WORDS", most)
        monkeypatch.setattr(kneser_ney, "ROWS", 7)
        want = model_by_hand(docs, trusted, most)
        score, limit = verdicts_by_hand(want, trusted)
        told = frame(spark, docs).repartition(3).withColumn("kept", F.lit("x")).withColumn("cost", F.lit(0)).withColumn("score", F.lit(0))
        got = {r["doc_id"]: r for r in kneser_ney.score(told, labels).collect()}
        assert len(got) == len(docs)
        for i, (cost, n) in want.items():
            assert got[i]["n_tokens"] == n and (got[i]["perplexity"] is None) == (n == 0)
            if n:  # a rounding more or less where logarithms differ in their last bit
                assert got[i]["perplexity"] == pytest.approx(math.exp(cost / 1000 / n) if cost < 700_000 * n else math.inf, rel=2e-5)
                assert got[i]["score"] == pytest.approx(score[i] / 1000, abs=0.0011) and got[i]["score_limit"] == pytest.approx(limit / 1000, abs=0.0021)
                assert got[i]["kept"] == (got[i]["score"] <= got[i]["score_limit"])
        assert got[200]["kept"] and got[201]["kept"] and not got[202]["kept"] and not got[205]["kept"]
        assert sum(got[i]["kept"] for i in trusted) >= 76


def test_language_model_counts_an_id_once(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(1, "a b c d e f g"), (1, "h i j"), (2, "a b c"), (2, "a b c"), (None, "a b"), (None, None)])
    rows = sorted((r["doc_id"] or 0, r["n_tokens"], r["kept"]) for r in kneser_ney.score(docs, labels).collect())
    assert [r[:2] for r in rows] == [(0, 0), (0, 0), (1, 10), (2, 6)] and rows[0][2] and rows[1][2]


def test_language_model_without_training_text(spark):
    docs = frame(spark, [(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r["kept"] for r in kneser_ney.score(docs, none).collect())
    assert kneser_ney.score(frame(spark, []), none).count() == 0


def test_packed_keys_round_trip():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    for top in (10, 2**17, 2**32):
        keys = np.sort(rng.integers(0, top, 500).astype(np.uint32))
        assert (kneser_ney._get(pa.py_buffer(kneser_ney._put(keys)), len(keys)) == keys).all()


def test_words_on_buffers():
    texts = ["a b", "", "  c", "d", "é\tf ", "g"]
    raw = [t.encode() for t in texts]
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    starts, ends, owner = tv.words(data, off)
    got = [(int(o), bytes(data[s:e]).decode()) for s, e, o in zip(starts, ends, owner, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.split()]
    h = tv.span_hash(data, starts, ends)
    assert len(set(h.tolist())) == len(h) and packed.FLUSH > 0


def test_pipeline_by_brute_force(spark, tmp_path):
    import corpus_pipeline

    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.vocabulary())
    rng = random.Random(21)
    sentence = lambda n=14: " ".join("".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."
    pool = [sentence(40) for _ in range(3)]
    rows = [(i, "\n".join([sentence(30), sentence(20), rng.choice([*pool, sentence()])])) for i in range(60)]
    item = sentence(12)
    near = sentence(200).split()
    rows += [(100, rows[3][1]), (101, "too short"), (102, "word " * 60), (103, sentence(30) + "\n" + item + "\n" + sentence(20)), (104, None), (105, " ".join(w + "#*" for w in sentence(60).split()))]
    changed = list(near)
    changed[100] = "changed"
    half = len(near) // 2
    rows += [(106, " ".join(near)), (107, " ".join([*changed[:half]]) + "\n" + " ".join(changed[half:]))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    def base_ok(t):
        w = (t or "").split()
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
        return len(w) >= 20 and 100 * len(covered) <= 30 * len(w) and "#*" not in t

    kept = [(i, t) for i, t in rows if base_ok(t)]
    gone = expected_lines(kept)
    lined = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])) for i, t in kept]
    lined = [(i, t) for i, t in lined if t.strip()]
    sets = {i: shingle_set(t) for i, t in lined}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = classes(sets, links)
    last = {i: t for i, t in lined if comp[i] == i and " ".join(re.findall(r"[a-z]+", item)) not in " ".join(re.findall(r"[a-z]+", t))}
    assert set(got) == set(last) and 103 not in got and 100 not in got and (106 in got) and 107 not in got
    for i, t in last.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    docs = queries.read(spark, str(tmp_path), "documents")
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = scratch.table(f(spark, docs, str(tmp_path)), name)
        assert docs.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("bound", [1000, 0])
def test_pipeline_edges(spark, tmp_path, monkeypatch, bound):
    """Nulls, repeated rows, clashing columns, an empty table; with and without a broadcast."""
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", bound)
    rng = random.Random(3)
    sentence = lambda n: " ".join("".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 8))) for _ in range(n)) + "."
    texts = [sentence(40) for _ in range(30)]
    rows = [(i, t, "en", "s", len(t), 7, "x", i) for i, t in enumerate(texts)]
    rows += [rows[3], (None, texts[4], "en", "s", 1, 8, "y", 1), (None, None, None, None, None, None, None, None), (50, texts[5], None, "s", 1, 9, "z", 2)]
    schema = DOCS + ", n_words long, kept string, component_id long"
    spark.createDataFrame([(1, "nothing of it")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, schema)
    for name, f in corpus_pipeline.STAGES:
        docs = scratch.table(f(spark, docs, str(tmp_path)), name)
        got = docs.collect()
        if name != "encode":
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            assert {r["doc_id"]: (r["n_words"], r["kept"], r["component_id"]) for r in got if r["doc_id"] in (0, 1)} == {0: (7, "x", 0), 1: (7, "x", 1)}
        ids = collections.Counter(r["doc_id"] for r in got)
        assert ids[3] == 2 and ids[None] == 1 and ids[50] == (name == "quality") and sum(ids.values()) == (33 if name == "quality" else 32)
    empty = spark.createDataFrame([], schema)
    for name, f in corpus_pipeline.STAGES:
        empty = scratch.table(f(spark, empty, str(tmp_path)), name)
        assert empty.count() == 0


@pytest.mark.parametrize("bits,n", [(44, 5), (64, 5), (64, 3000), (44, 1 << 21)])
def test_distinct_values(bits, n):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 20, 4000).astype(np.uint64) << np.uint64(bits - 21)
    h = np.r_[h, h[:500], h[:500] + np.uint64(1)]  # some agree in all but their last bit
    owner = rng.integers(0, n, len(h))
    got, bounds = tv.distinct(h, owner, n, bits)
    want = sorted({(int(o), int(x)) for o, x in zip(owner, h, strict=True)})
    assert [(int(o), int(x)) for o, x in zip(np.repeat(np.arange(n), np.diff(bounds)), got, strict=True)] == want
    assert len(tv.distinct(h[:0], owner[:0], 1, bits)[0]) == 0
