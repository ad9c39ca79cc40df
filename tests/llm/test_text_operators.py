"""BPE, token counts, decontamination, quality rules, personal data, preferences, licences."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import bpe, contamination, licenses, pii, preference, quality_rules, queries, wordpiece

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    None, "", " \t\n ", "one", "the cat sat on the mat " * 3, "the cat sat on the mat " * 3, "<|endoftext|>a<|startoftext|> b <|ENDOFTEXT|>", "aaaa" * 300, "ΑΣ ΣΑΣ é ﬁ İ 123 4５ it's I'LL",
    "漢字 かな 😀😀 é", "x y " * 4000, "Ᲊ꟎\U0001e6c0 new letters", "tab\x0bfeed\x1funit\x85next line",
]


def frame(spark, texts, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(queries.vocabulary())


def test_bpe_equals_the_library(spark, tokenizer):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abcdefghi jklmno.pqé漢😀'\n") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    docs = frame(spark, texts)
    rows = {r["doc_id"]: r for r in bpe.decode(bpe.encode(docs, queries.vocabulary()), queries.vocabulary()).collect()}
    digests = {r["doc_id"]: r for r in queries.bpe_digests(bpe.encode(docs, queries.vocabulary(), packed=True, decoded=True)).collect()}
    for i, t in enumerate(texts):
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        said = tokenizer.decode(want, skip_special_tokens=False)
        assert list(rows[i]["token_ids"]) == want and rows[i]["decoded"] == said and rows[i]["n_tokens"] == len(want)
        assert digests[i]["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_bpe_every_code_point(tokenizer):
    codec = bpe.Codec(queries.vocabulary())
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    ids, at = codec.encoder().encode(texts)
    wrong = [i for i, e in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)) if e.ids != ids[at[i] : at[i + 1]].tolist()]
    assert not wrong


def test_bpe_small_caches_and_clashing_columns(spark, monkeypatch):
    codec = bpe.Codec(queries.vocabulary())
    texts = [t or "" for t in ODD] * 3
    whole, at = codec.encoder().encode(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 10)
    again, at2 = codec.encoder().encode(texts)
    assert (whole == again).all() and (at == at2).all()
    docs = frame(spark, ODD).withColumn("n_tokens", F.lit("x")).withColumn("extra", F.lit(1))
    out = bpe.encode(docs, queries.vocabulary())
    assert out.columns.count("n_tokens") == 1 and dict(out.dtypes)["n_tokens"] == "bigint" and "extra" in out.columns
    assert bpe.encode(frame(spark, []), queries.vocabulary()).count() == 0


def test_word_pieces_are_greedy(spark):
    codec = bpe.Codec(queries.vocabulary())
    byte = {c: i for i, c in enumerate(bpe.byte_letters())}
    names = codec.names[: -len(codec.special)]
    stem = lambda name: bytes(byte[c] for c in name.removesuffix("</w>"))
    inner, final = {stem(n) for n in names if not n.endswith("</w>")} - {b""}, {stem(n) for n in names if n.endswith("</w>")}
    most = max(map(len, inner | final))

    def greedy(word):
        s, i, n = word.encode(), 0, 0
        while i < len(s):
            i += next(k for k in range(min(most, len(s) - i), 0, -1) if s[i : i + k] in (final if i + k == len(s) else inner))
            n += 1
        return n

    texts = ODD + ["supercalifragilistic expialidocious words", "ab" * 50_000, "the" * 90]
    docs = frame(spark, texts).withColumn("n_words", F.lit("x")).withColumn("extra", F.lit(1))
    out = wordpiece.count(docs, queries.vocabulary())
    assert sorted(out.columns) == sorted({*docs.columns, "n_pieces"})
    rows = out.orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        words = codec.words(t or "")
        assert r["n_words"] == len(words) and r["n_pieces"] == sum(1 if w in codec.special else greedy(w) for w in words)
    assert wordpiece.count(frame(spark, []), queries.vocabulary()).count() == 0


@pytest.mark.parametrize("long", [wordpiece.LONG, 3])
def test_automaton_on_random_vocabularies(monkeypatch, long):
    monkeypatch.setattr(wordpiece, "LONG", long)
    rng = random.Random(5)
    for _ in range(40):
        inner, final = ({bytes(rng.choice([97, 98]) for _ in range(rng.randint(1, 4))) for _ in range(6)} for _ in range(2))
        machine = wordpiece.Automaton(sorted({tuple(p) for p in inner} | {(*p[:-1], p[-1] + 256) for p in final}))
        words = [bytes(rng.choice([97, 98]) for _ in range(rng.randint(0, 9))) for _ in range(30)]
        for word, got in zip(words, machine.counts(words).tolist(), strict=True):
            i = n = 0
            while i < len(word) and n >= 0:
                k = next((k for k in range(len(word) - i, 0, -1) if word[i : i + k] in (final if i + k == len(word) else inner)), 0)
                i, n = (i + k, n + 1) if k else (i, -1)
            assert got == n


def test_decontamination_by_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    vocab = ["alpha", "Beta", "g4", "été", "ß", "x"]
    say = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [say(rng.randint(1, 14)) for _ in range(12)] + [None, "", "?!", "alpha"]
    items.append(items[0])
    docs = [say(rng.randint(0, 60)) + " " + (rng.choice(items) or "") + "." + say(5) for _ in range(60)] + ODD
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: word.findall((t or "").translate(lower))
    docs += docs[:3]
    bench = spark.createDataFrame([*enumerate(items), (None, docs[0])], "item_id long, text string")
    for most in (contamination.MOST, 20):  # one automaton, then several
        monkeypatch.setattr(contamination, "MOST", most)
        told = contamination.scan(frame(spark, docs).withColumn("n_hit", F.lit("x")).withColumn("items", F.lit(1)), bench)
        assert sorted(told.columns) == sorted({*frame(spark, []).columns, "n_words", "n_hit", "items", "hits"})
        rows = told.orderBy("doc_id").collect()
        assert len(rows) == len(docs)
        for r, t in zip(rows, docs, strict=True):
            d, hit, found = words(t), set(), set()
            for k, item in enumerate(items):
                w = words(item)
                n = min(10, len(w))
                for i in range(len(w) - n + 1 if n else 0):
                    for j in range(len(d) - n + 1):
                        if d[j : j + n] == w[i : i + n]:
                            hit.update(range(j, j + n))
                            found.add(str(k))
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(d), len(hit), sorted(found))
            assert sum(len(words(t[s["start"] : s["end"]])) for s in r["hits"]) == len(hit)
    assert contamination.scan(frame(spark, ["alpha"]), bench.limit(0)).first()["n_hit"] == 0
    assert contamination.scan(frame(spark, []), bench).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_sql(name, against_sql):
    against_sql(queries.QUERIES[name], queries.SQL[name])


def test_quality_base_measures(spark):
    rng = random.Random(9)
    texts = ODD + ["\n".join(" ".join(rng.choice("abc#") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 8))) for _ in range(80)]
    rows = quality_rules.apply(frame(spark, texts)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)} if len(windows) < 3000 else None
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)))
        if covered is not None:
            assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 20 or 100 * r["n_repeat_words"] > 30 * len(words))
        assert not (r["kept"] and r["base_failed"])


def test_quality_adapts_to_groups(spark):
    rng = random.Random(11)
    clean = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(40))
    marked = lambda: " ".join(w + "#" for w in clean().split())
    rows = [(i, clean(), "en", "prose", 0) for i in range(300)] + [(1000 + i, marked(), "en", "prose", 0) for i in range(30)] + [(2000 + i, marked(), "en", "code", 0) for i in range(300)]
    rows += [(3000, clean(), None, None, 0), (3001, marked(), "xx", "few", 0)]
    out = {r["doc_id"]: r["kept"] for r in quality_rules.apply(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(out[i] for i in range(300)) and not any(out[1000 + i] for i in range(30)) and all(out[2000 + i] for i in range(300)) and out[3000]
    assert quality_rules.apply(frame(spark, [])).count() == 0


def test_quality_limits_come_from_the_sketch(spark):
    """The same text passes in a group that is like it and fails in one that is not."""
    rng = random.Random(4)
    say = lambda low, high: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(low, high))) for _ in range(40))
    rows = [(i, say(3, 7), "en", "short", 0) for i in range(400)] + [(1000 + i, say(3, 14), "en", "mixed", 0) for i in range(400)]
    long = say(9, 10)
    rows += [(5000, long, "en", "short", 0), (5001, long, "en", "mixed", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"n_words": F.lit("x"), "kept": F.lit("y"), "failed": F.lit(0), "extra": F.lit(1)})
    out = quality_rules.apply(docs)
    assert sorted(out.columns) == sorted(set(out.columns)) and "extra" in out.columns and dict(out.dtypes)["n_words"] == "bigint"
    found = {r["doc_id"]: r for r in out.collect()}
    assert found[5000]["failed"] == ["word_length"] and not found[5000]["kept"] and found[5001]["kept"]
    assert sum(found[i]["kept"] for i in range(400)) >= 398
    again = quality_rules.apply(docs.union(docs.where("doc_id = 5000")))
    assert [r["kept"] for r in again.where("doc_id = 5000").collect()] == [False, False]


def test_quality_joins_alike_without_broadcasts(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choice("abcdeFG#") for _ in range(rng.randint(1, 9))) for _ in range(30)), rng.choice(["en", "de", None]), f"s{i % 3}", 0) for i in range(300)]
    kept = lambda: sorted((r["doc_id"], r["kept"]) for r in quality_rules.apply(spark.createDataFrame(rows, DOCS)).collect())
    first = kept()
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 0)
    assert kept() == first


def test_sketches_merge(spark):
    rows = [(i, " ".join("w" * (1 + (i * k) % 9) for k in range(30)), "en", f"s{i % 3}", 0) for i in range(200)]
    measured = quality_rules.measure(spark.createDataFrame(rows, DOCS))
    whole = quality_rules.merge(quality_rules.sketch(measured), ["_q_lang"])
    parts = quality_rules.merge(quality_rules.sketch(measured.where("doc_id < 90")).union(quality_rules.sketch(measured.where("doc_id >= 90"))), ["_q_lang"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m)
        luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]

    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t) if ok(k, m.group())]


def test_personal_data_base(spark):
    rng = random.Random(13)
    texts = ODD + [
        "a@b.c_d@e.f x@y..z q@w.e. a@b@c.d..e -a@-.-b", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1111 4111  1111", "+1 (555) 123-4567. +44 20 7946 0958 +12",
        "é@x.de 日本 me@日.jp me+tag@sub.example.co.uk 😀 b@c.de", "9 " * 3000, "a.b" * 200 + "@" + "c." * 3000 + "d", "1" * 5000, "@" * 300, "a" * 20000 + "@b.c", "+" + "1-" * 4000,
    ]
    texts += ["".join(rng.choice("ab@.-_1 4+()") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    rows = pii.detect(frame(spark, texts)).orderBy("doc_id").select("doc_id", pii.joined(pii.base_list()).alias("base"), pii.joined(F.col("spans")).alias("all")).collect()
    for r, t in zip(rows, texts, strict=True):
        assert r["base"].split(",") == (base_spans(t or "") or [""])
        assert set(filter(None, r["base"].split(","))) <= set(r["all"].split(","))
    assert pii.detect(frame(spark, [])).count() == 0


def added_by_hand(texts):
    """Candidates, votes and features by Python's re; the estimation and the classifier are the module's."""
    from pyspark.sql import Row

    digits = lambda m: re.sub("[^0-9]", "", m)
    patterns = PATTERNS | {k: p.replace("++", "+") for k, (p, _) in pii._PROPOSALS.items()}
    near = pii._NEAR
    found = []
    for d, t in enumerate(texts):
        for kind in pii.KINDS:
            end, before_last = 0, ""
            for m in re.finditer(patterns[kind], t):
                s, x, n = m.start(), m.group(), len(digits(m.group()))
                if kind == "ip" and any(int(p) > 255 for p in x.split(".")) or kind == "card" and not 13 <= n <= 19 or kind == "phone" and not 9 <= n <= 15:
                    continue
                before = (before_last + t[end:s])[-pii.BEFORE :].lower()
                end, before_last = m.end(), x
                vote = lambda yes, no=False: 1 if yes else -1 if no else 0
                luhn = kind == "card" and f"card:{s}:{end}" in base_spans(t)
                form = {
                    "email": lambda: vote(re.search("^[A-Za-z0-9]", x) and re.search(r"\.[A-Za-z]{2,}$", x), not re.search("[A-Za-z]", x)),
                    "national_phone": lambda: vote(x[0] == "(", "." in x), "id_number": lambda: vote(re.search("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", x), True), "secret": lambda: 0,
                }[kind]()
                gazetteer = {
                    "email": lambda: vote(re.search(rf"(?i)\.(?:{pii._TLD})$", x)), "national_phone": lambda: vote(digits(x)[0] > "1", digits(x)[0] < "2"),
                    "id_number": lambda: 0, "secret": lambda: vote(re.match(pii._ISSUED, x)),
                }[kind]()
                distinct = len(set(x.lower()))
                votes = [form, gazetteer, vote(re.search(near[kind], before)), vote(False, re.search(pii._AGAINST, before)), vote(luhn, True) if kind == "card" else vote(False, distinct <= 3), vote(re.search(r"[=:] ?[\"'(<]?$", before))]
                found.append((d, kind, s, end, votes, [int(before[-1:] in ("\"", "'", "(", "<", "[") and before != ""), int(len(x) > 24), int(distinct >= 10)]))
    counts = {}
    for _, kind, _, _, votes, features in found:
        counts[kind, *votes, *features] = counts.get((kind, *votes, *features), 0) + 1
    rows = sorted(Row(**dict(zip(["kind", *pii.VOTES, *pii.FEATURES], k, strict=True)), n=n) for k, n in counts.items())
    post, _ = pii.estimate(rows)
    w = pii.train(rows, post)
    out = {}
    for d, kind, s, e, votes, features in found:
        z = w["bias"] + w[kind] + sum(w[f"{v}{'+' if x > 0 else '-'}"] for v, x in zip(pii.VOTES, votes, strict=True) if x) + sum(w[f] for f, x in zip(pii.FEATURES, features, strict=True) if x)
        base = [tuple(map(int, b.split(":")[1:])) for b in base_spans(texts[d])]
        if kind in pii.BASE or z >= 0 and not any(a < e and s < b for a, b in base):
            out.setdefault(d, []).append(f"{kind}:{s}:{e}")
    return out


def test_personal_data_added_by_hand(spark):
    rng = random.Random(8)
    mixed = lambda n: "".join(rng.choice("abcdef") + rng.choice("0123456789") for _ in range(n))
    key = lambda: rng.choice(["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMN23") for _ in range(16)), "ghp_" + "a1B2c3" * 6, mixed(20), mixed(16).upper()])
    frames = ['token = "{}" here', "the commit {} of version two", "note {}", "api key: {}", "checksum {}", "see ({}) and mail me"]
    texts = ["A start. " + rng.choice(frames).format(key()) + rng.choice([" end", " then " + rng.choice(frames).format(key()), ""]) for _ in range(200)]
    texts += [rng.choice(["call (212) 555-{}", "ssn 123-45-{}", "version 212.555.{}", "order 900-00-{}", "mail joe{}@site.example.org"]).format(rng.randint(1000, 9999)) for _ in range(100)]
    want = added_by_hand(texts)
    docs = frame(spark, texts).withColumn("spans", F.lit(1)).withColumn("base", F.lit(2))
    out = pii.detect(docs)
    assert out.columns.count("spans") == 1 and out.columns.count("base") == 1
    got = {r["doc_id"]: r["s"] for r in out.select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    assert got == {d: ",".join(want.get(d, [])) for d in range(len(texts))} and len(want) > 100
    twice = pii.detect(frame(spark, texts[:20] + texts[:20])).orderBy("doc_id").select(pii.joined(F.col("spans"))).collect()
    assert twice[:20] == twice[20:]


def test_running_sums(spark):
    from siltworks.llm import native

    rng = random.Random(2)
    rows = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 1000)]
    found = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i long, v array<int>").orderBy("i").select(native.running(F.col("v"))).collect()
    assert [list(r[0]) for r in found] == [np.cumsum(r).tolist() for r in rows]


def test_personal_data_adds_what_votes_support(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(30)]
    texts = [f'api token = "{h}" for login' for h in hexes] + [f"call our phone ({200 + i}) 555-{1000 + i} today" for i in range(30)]
    texts += [f"release checksum version {h}" for h in hexes] + ["plain prose without any number at all"] * 5
    rows = pii.detect(frame(spark, texts)).orderBy("doc_id").select(pii.joined(F.col("spans")).alias("s")).collect()
    found = [r["s"] for r in rows]
    assert all(s.startswith("secret:") for s in found[:30]) and all(s.startswith("national_phone:") for s in found[30:60])
    assert sum(bool(s) for s in found[60:90]) < 30 and not any(found[90:])


def test_reliabilities_are_estimated():
    from pyspark.sql import Row

    rng, rows = random.Random(1), {}
    for _ in range(4000):
        true = rng.random() < 0.5
        votes = [(1 if true == (rng.random() < a) else -1) for a in (0.95, 0.9, 0.6)] + [0, 0, 0]
        rows[tuple(votes)] = rows.get(tuple(votes), 0) + 1
    data = [Row(kind="email", **dict(zip(pii.VOTES, v, strict=True)), f0=0, f1=0, f2=0, n=n) for v, n in rows.items()]
    _, labelers = pii.estimate(data)
    assert abs(labelers["email", 0] - 0.95) < 0.04 and abs(labelers["email", 1] - 0.9) < 0.04 and abs(labelers["email", 2] - 0.6) < 0.04


def test_weak_labelers_and_rare_kinds_are_estimated():
    from pyspark.sql import Row

    rng, rows = random.Random(3), {}
    for kind, share in (("email", 0.5), ("secret", 0.1)):
        for _ in range(8000):
            true = rng.random() < share
            votes = [(1 if true == (rng.random() < a) else -1) for a in (0.95, 0.9, 0.6)] + [0, 0, 0]
            rows[kind, tuple(votes)] = rows.get((kind, tuple(votes)), 0) + 1
    lone = [("secret", (0, 0, 1, 0, 0, 0))]
    data = [Row(kind=k, **dict(zip(pii.VOTES, v, strict=True)), f0=0, f1=0, f2=0, n=n) for (k, v), n in rows.items()]
    data += [Row(kind=k, **dict(zip(pii.VOTES, v, strict=True)), f0=0, f1=0, f2=0, n=1) for k, v in lone]
    post, labelers = pii.estimate(data)
    assert abs(labelers["email", 0] - 0.95) < 0.03 and abs(labelers["email", 1] - 0.9) < 0.03 and abs(labelers["email", 2] - 0.6) < 0.03
    assert post[("secret", 0, 0, 1, 0, 0, 0)] < 0.3  # one vote of a weak labeler for a rare kind


def test_preferences(spark):
    turn = lambda r, c: {"role": r, "content": c}
    u, a, b, s = turn("user", "hi é😀"), turn("assistant", "A"), turn("assistant", "B"), turn("system", "s")
    cases = [([s, u, a], [s, u, b]), ([u, a], [u, a]), ([u], [u, a, u, b]), ([], []), (None, [u]), ([turn(None, None), a], [turn("", ""), b]), ([a], [b])]
    pairs = spark.createDataFrame([(i, c, r) for i, (c, r) in enumerate(cases)], f"id long, chosen {preference.TURN}, rejected {preference.TURN}")
    text = lambda ts: "".join(f"<|{t['role'] or ''}|>\n{t['content'] or ''}<|end|>\n" for t in ts)
    for r, (c, d) in zip(preference.format_pairs(pairs).orderBy("id").collect(), cases, strict=True):
        c, d = ([(t["role"] or "", t["content"] or "") for t in x or []] for x in (c, d))
        n = next((i for i, (p, q) in enumerate(zip(c, d, strict=False)) if p != q), min(len(c), len(d)))
        for side, rest in (("chosen", c[n:]), ("rejected", d[n:])):
            whole = text([turn(*x) for x in rest])
            assert r[f"{side}_completion"] == whole and r["prompt"] == text([turn(*x) for x in c[:n]])
            assert [whole[m["s"] : m["e"]] for m in r[f"{side}_mask"]] == [x[1] + preference.END for x in rest if x[0] == "assistant"]
        assert r["n_prompt_turns"] == n
    wide = spark.createDataFrame([(i, c, r, "x", 1) for i, (c, r) in enumerate(cases)] * 2, f"id long, chosen {preference.TURN}, rejected {preference.TURN}, prompt string, extra int")
    again = preference.format_pairs(wide)
    assert again.columns.count("prompt") == 1 and again.count() == 2 * len(cases) and again.where("prompt = 'x'").count() == 0
    many = [turn("user" if i % 2 else "assistant", "t" * (i % 7)) for i in range(5000)]
    row = preference.format_pairs(spark.createDataFrame([(0, many, [])], f"id long, chosen {preference.TURN}, rejected {preference.TURN}")).first()
    assert len(row["chosen_mask"]) == 2500 and [row["chosen_completion"][m["s"] : m["e"]] for m in row["chosen_mask"]] == [x["content"] + preference.END for x in many if x["role"] == "assistant"]
    turns = spark.createDataFrame([(None, 0, "user", "lost"), (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert [(r["conv_id"], len(r["chosen"])) for r in preference.conversations(turns).collect()] == [(1, 3)]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.format_pairs(preference.with_rejected(preference.conversations(empty))).count() == 0


def test_licences_held_out(spark):
    """Recall of every family on frames, languages and wordings that training has not seen."""
    docs = ["Some prose here.\nLicensed under the Apache License, Version 2.0.\nMore.", "Released under the MIT License.", "He lost his license.\nThe vote is reserved for members.", None, "", "\n\n", "Licensed under CC BY-NC 4.0.\n\nReleased under the MIT License.", "Prose.\nAll rights reserved."]
    frames = [
        "You may use these files as the {} allows.", "Unless stated otherwise, everything in this folder falls under the {}.", "Dieses Werk steht unter der {} und darf geteilt werden.", "Ce logiciel est fourni sous {} par ses auteurs.",
        "Este trabajo se ofrece con {}.", "Opera distribuita con licenza {}", "Obra sob a {}, veja o arquivo.", "{} applies to all parts of the package", "// {}", "Terms of use: {}; contact us for others",
    ]
    own = {"proprietary": ["Copyright 1999-2004, the editors: {}", "{}!", "Owner of this work: the museum. {} worldwide.", "© {}"]}
    planted = [(family, f.format(n)) for family in licenses.NAMES for n in licenses.NAMES[family] for f in own.get(family, frames)]
    held = {"gpl": "see the GNU General Public License for more details, as published by the Free Software Foundation, either version 2 or any later version", "bsd": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"}
    planted += list(held.items())
    odd = "The committee reserved all rooms.|A copy of the permission slip is required.|public opinion and general interest|the license plate of the red car|mozilla is a project with public meetings|The apache people live in the desert.|MIT is a university".split("|")
    every = docs + [t for _, t in planted] + odd
    wide = frame(spark, every).withColumn("licenses", F.lit("x")).withColumn("extra", F.lit(1))
    out = licenses.scan(wide)
    assert sorted(out.columns) == sorted({*wide.columns, "n_paragraphs"})
    rows = out.orderBy("doc_id").collect()
    found = [[(x["family"], x["line"]) for x in r["licenses"]] for r in rows]
    assert found[: len(docs)] == [[("apache", 1)], [("mit", 0)], [], [], [], [], [("cc-by-nc", 0), ("mit", 2)], [("proprietary", 1)]]
    assert [r["n_paragraphs"] for r in rows[: len(docs)]] == [3, 1, 2, 0, 0, 0, 2, 2]
    hit, seen = {}, {}
    for (family, _), got in zip(planted, found[len(docs) :], strict=False):
        seen[family] = seen.get(family, 0) + 1
        hit[family] = hit.get(family, 0) + (got == [(family, 0)])
    assert {f: hit[f] / seen[f] for f in seen if hit[f] <= 0.9 * seen[f]} == {}
    assert found[len(docs) + len(planted) :] == [[]] * len(odd)
    assert licenses.scan(frame(spark, [])).count() == 0


def test_licence_probabilities_by_hand():
    model = licenses.fit()
    texts = ["Released under the MIT License.", "Some words of no licence, and others", "GNU", "", "Licensed under CC BY-SA 4.0 by é"]
    got = model.probabilities(*licenses._flat(texts))
    place = {k: i for i, k in enumerate(model.keys.tolist())}
    for text, p in zip(texts, got, strict=True):
        data, off = licenses._flat([text])
        h, _, pair, _ = licenses._grams(data, off)
        grams = [*h.tolist(), *pair.tolist()]
        known = [place[g] for g in grams if g in place]
        z = [sum(model.weights[k][c] for k in known) / max(1, len(grams)) ** 0.5 + (1 - len(known) / max(1, len(grams))) * model.weights[-2][c] + model.weights[-1][c] for c in range(len(model.families))]
        e = [np.exp((x - max(z)) / model.temperature) for x in z]
        assert np.allclose(p, [x / sum(e) for x in e] if grams else [0] * len(e))


def test_background_is_bounded(spark):
    texts = [f"a plain paragraph number {i} of prose\nanother line of it {i}" for i in range(50)] + ["one and the same paragraph here"] * 30 + [None, "", "all rights reserved by law", "x"]
    found = licenses.background(frame(spark, texts), most=20)
    assert len(found) == len(set(found)) == 20 and not any("rights" in p for p in found) and found == licenses.background(frame(spark, texts).repartition(3), most=20)


def test_licences_inside_long_lines(spark):
    rng = random.Random(4)
    prose = "river stone market evening teacher window garden letter mountain kitchen bridge winter music paper doctor village table morning street bottle".split()
    notices = {
        "mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.", "cc-by-nc": "This work is licensed under the CC BY-NC 4.0.",
        "gpl": licenses._NOTICES["gpl"][0], "lgpl": licenses._NOTICES["lgpl"][0], "isc": licenses._NOTICES["isc"][0],
        "agpl": licenses._NOTICES["gpl"][0].replace("GNU General", "GNU Affero General"),
    }
    goal, docs = [], []
    for family, notice in notices.items():
        for size in (0, 20, 60, 400):
            words = [rng.choice(prose) for _ in range(size)]
            at = rng.randint(0, size)
            docs.append(" ".join([*words[:at], notice, *words[at:]]))
            goal.append([(family, 0)])
    docs.append("Dual licensed: released under the MIT License or licensed under the Apache License, Version 2.0, at your choice.")
    goal.append([("apache", 0), ("mit", 0)])
    docs += [" ".join(rng.choice(prose) for _ in range(400)), "The driver lost his license after the accident and had to take the test again. " * 10]
    goal += [[], []]
    rows = licenses.scan(frame(spark, docs)).orderBy("doc_id").collect()
    assert [[(x["family"], x["line"]) for x in r["licenses"]] for r in rows] == goal
