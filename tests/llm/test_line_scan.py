"""Lines, their shingles and trees of few sets against brute force."""

import random

import numpy as np
import pytest

from siltworks.llm import line_dedup, prefix_tree

WHITE = " \t\n\x0b\x0c\r"


def similar_pairs(groups, members, t=80):
    pairs = [(i, j) for j in range(len(members)) for i in range(j) if groups[i] == groups[j]]
    return {(i, j) for i, j in pairs if 100 * len(np.intersect1d(members[i], members[j])) >= t * len(np.union1d(members[i], members[j])) > 0}


def test_paths_that_end_where_a_segment_does():
    """The first set's path, of a segment bound's length, begins those of two others, which are similar."""
    for depth in (6, 14, 30, 62, 126):
        longer = depth + depth // 3 + 2
        base = np.arange(1, longer + 1, dtype=np.uint64)
        members = [base[:depth], np.r_[base, np.uint64(1000)], np.r_[base, np.uint64(1001)]]
        assert similar_pairs([0, 0, 0], members) == {(1, 2)}
        tree = prefix_tree.Forest(np.zeros(3, np.int64), np.concatenate(members), np.r_[0, np.cumsum([len(m) for m in members])], 80)
        assert depth in tree.depth
        assert {tuple(sorted((int(i), int(j)))) for i, j in zip(*tree.links(), strict=True)} == {(1, 2)}


@pytest.mark.parametrize("work", [prefix_tree.WORK, 300])
def test_small_trees_go_pair_by_pair(monkeypatch, work):
    monkeypatch.setattr(prefix_tree, "WORK", work)
    rng = np.random.default_rng(4)
    groups, members = [], []
    for g in range(60):
        base = np.unique(rng.integers(0, 1 << prefix_tree.SHORT, 120).astype(np.uint64))
        for _ in range(rng.integers(1, prefix_tree.FEW + 1)):
            groups.append(g)
            members.append(np.unique(np.r_[base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])], rng.integers(0, 1 << prefix_tree.SHORT, 3).astype(np.uint64)]))
    members[5] = np.zeros(0, np.uint64)
    large = prefix_tree.FEW + 5
    groups += [60] * large
    members += members[-1:] * large
    made = []
    forest = prefix_tree.Forest
    monkeypatch.setattr(prefix_tree, "Forest", lambda tree, h, bounds, t: made.append(len(tree)) or forest(tree, h, bounds, t))
    i, j = prefix_tree.links(np.array(groups), np.concatenate(members), np.array([len(m) for m in members]), 80)
    assert made == [large]  # a tree is built for the large one only
    own = i < len(groups) - large
    assert {(int(a), int(b)) for a, b in zip(i[own], j[own], strict=True)} == {p for p in similar_pairs(groups, members) if groups[p[0]] < 60}
    assert set(i[~own].tolist()) | set(j[~own].tolist()) == set(range(len(groups) - large, len(groups)))


def test_lines_by_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        texts = ["".join(rng.choice("ab \n\n\t\ré😀\x0b\x1f\x85\xa0") for _ in range(rng.choice([0, 1, 9, 40, 200]))) for _ in range(rng.randint(1, 6))]
        raw = [t.encode() for t in texts]
        lines = line_dedup.Lines(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])])
        want = [(i, n, x) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n")) if x.strip(WHITE)]
        every = np.arange(len(want))
        assert list(zip(lines.owner.tolist(), lines.number.tolist(), lines.texts(every), strict=True)) == want
        assert len(set(zip(lines.ids.tolist(), (x for *_, x in want), strict=True))) == len(set(lines.ids.tolist())) == len({x for *_, x in want})
        which = every[::2]
        for kind in (np.uint32, np.uint64):
            h, bounds = lines.shingles(which, kind)
            shingles = [x[k : k + 8] for *_, x in want[::2] for k in range(max(1, len(x) - 7))]
            assert h.dtype == kind and np.diff(bounds).tolist() == [max(1, len(x) - 7) for *_, x in want[::2]]
            assert len(set(zip(h.tolist(), shingles, strict=True))) == len(set(h.tolist())) == len(set(shingles))


def test_lines_that_are_no_utf8():
    raw = b"caf\xe9 au lait\nplain line\xff"
    lines = line_dedup.Lines(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert lines.texts(np.arange(2)) == ["café au lait", "plain line\xff"]
    assert np.diff(lines.shingles(np.arange(2))[1]).tolist() == [5, 4]


def test_keys_of_a_single_entry_are_left_out():
    key = np.array([7, 1, 9, 7, 2, 9, 9, 4], np.uint32)
    assert sorted(line_dedup._met(key).tolist()) == [0, 2, 3, 5, 6]
    assert not len(line_dedup._met(key[:0])) and not len(line_dedup._met(key[:1]))
