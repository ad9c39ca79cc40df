"""Claims of licence families against a plain version, and very long paragraphs."""

import re
import time

import numpy as np
import pytest

from siltworks.llm import licenses, queries

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text):
    return [(m.start(), m.end(), m[0]) for m in WORD.finditer(text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))]


def claims(model, text, least=0.5):
    """The families of one paragraph, window by window and pair by pair."""
    raw, w = text.encode(), words(text)
    if not w:
        return {}
    token = [x[2] for x in w]
    known = {f: {tuple(t[i : i + 2]) for n in licenses._NOTICES.get(f, []) for t in [[x[2] for x in words(n)]] for i in range(len(t) - 1)} for f in licenses.NAMES}
    every = set().union(*known.values())
    names = {f: [[x[2] for x in words(n)] for n in own] for f, own in licenses.NAMES.items()}
    rows = set()
    for own in names.values():
        for k in own:
            for i in range(len(token) - len(k) + 1):
                if token[i : i + len(k)] == k:
                    rows |= {(max(0, i - x), min(len(w), i + len(k) + y)) for x, y in licenses.AROUND}
    pairs = [tuple(token[i : i + 2]) for i in range(len(token) - 1)]
    for size in licenses.WINDOWS:
        starts = {max(0, min(i, len(w) - size)) for i in range(0, max(len(w) - size, 0) + size // 4, size // 4)}
        for i in starts:
            j = min(i + size, len(w))
            if j - i >= 7 and sum(p in every for p in pairs[i : j - 1]) >= 0.6 * (j - i - 1) - 1e-9:
                rows.add((i, j))
    found = []
    for i, j, a, b in [(0, len(w), 0, len(raw))] + [(i, j, w[i][0], w[j - 1][1]) for i, j in sorted(rows)]:
        p = model.probabilities(*licenses._flat([raw[a:b].decode()]))[0]
        family = model.families[int(p.argmax())]
        if family == licenses.UNKNOWN or p.max() < least:
            continue
        own = pairs[i : j - 1]
        share = lambda f, own=own: sum(x in known[f] for x in own) / len(own) if own else 0.0
        named = any(token[s : s + len(k)] == k for k in names[family] for s in range(i, j - len(k) + 1))
        if named or len(own) >= 6 and share(family) >= 0.6:
            found.append((not named, -share(licenses.KIN.get(family, family)) * len(own), -p.max(), a, b, family, {f: share(licenses.KIN.get(f, f)) for f in names}))
    out, taken = {}, []
    for f in sorted(found, key=lambda f: (f[0], round(f[1], 9), f[2:6])):
        rivals = [g for g in taken if g[5] != f[5]]
        if f[0] and any(f[6][g[5]] >= 0.6 if not g[0] else g[3] < f[4] and f[3] < g[4] for g in rivals):
            continue
        taken.append(f)
        out[f[5]] = max(out.get(f[5], 0.0), -f[2])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_claims_by_brute_force(seed):
    model = licenses.fit()
    rng = np.random.default_rng(seed)
    notices = [x for v in licenses._NOTICES.values() for x in v] + [f.format(n) for f in licenses._FRAMES for v in licenses.NAMES.values() for n in v]
    filler = " ".join(licenses._OTHER).split()
    lines = ["", "  ", "MIT License", "the MIT"]
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 4)):
            own = notices[rng.integers(len(notices))].split()
            cut = rng.integers(0, max(1, len(own) // 2))
            parts += [*rng.choice(filler, rng.integers(0, 50)).tolist(), *own[cut:]]
        lines.append(" ".join(parts))
    data, off = licenses._flat(lines)
    got = model.claims(data, off, model.probabilities(data, off), 0.5)
    want = {i: c for i, line in enumerate(lines) if (c := claims(model, line))}
    assert {i: sorted(c) for i, c in got.items()} == {i: sorted(c) for i, c in want.items()}
    assert all(abs(got[i][f] - want[i][f]) < 1e-9 for i in want for f in want[i])
    assert len(want) > 40


def test_very_long_paragraphs():
    """Names and notices over and over in one line: time grows with its length."""
    model = licenses.fit()
    rng = np.random.default_rng(4)
    notices = [x for v in licenses._NOTICES.values() for x in v]
    for unit, expected in (("released under the MIT License or the Apache License ", {"mit", "apache"}), (" ".join(rng.choice(notices, 40).tolist()) + " ", None)):
        took = []
        for size in (100_000, 1_000_000):
            data, off = licenses._flat([(unit * (size // len(unit) + 1))[:size]])
            whole = model.probabilities(data, off)
            began = time.process_time()
            got = model.claims(data, off, whole, 0.5)
            took.append(time.process_time() - began)
            assert expected is None or set(got[0]) == expected
        assert took[0] < 1 and took[1] < 30 * max(took[0], 0.1)


def test_repeated_rows_and_odd_texts(spark):
    rows = [(1, "Released under the MIT License.\nmore words"), (1, "Released under the MIT License.\nmore words"), (None, "GPLv3"), (2, None), (3, "\n\n"), (4, "x" * 200_000)]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, licenses string")
    got = [(r["doc_id"], [x["family"] for x in r["licenses"]], r["n_paragraphs"]) for r in licenses.scan(df).collect()]
    assert got == [(1, ["mit"], 2), (1, ["mit"], 2), (None, ["gpl"], 1), (2, [], 0), (3, [], 0), (4, [], 1)]
    assert licenses.scan(df.limit(0)).count() == 0
    assert "op6_licenses" in queries.QUERIES
