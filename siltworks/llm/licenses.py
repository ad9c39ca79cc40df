"""Licence scans with a trained paragraph classifier.

Method: paragraphs (lines) are bags of word unigrams and bigrams.  A
multinomial logistic regression over the n-grams of the training notices gives
each licence family a probability; its temperature is fitted on held-out
notices, and what no family explains well falls to the class ``unknown``,
which is trained on ordinary and licence-like sentences.  A prediction counts
only when the family's templates confirm it: the paragraph holds one of the
family's names, or most of its bigrams stand in the family's notices.

A licence inside a longer paragraph is found in windows of about the length of
the training notices: around every occurrence of a name, and overlapping ones
wherever most bigrams stand in some notice; elsewhere no family can be
confirmed.  A paragraph may have several families.  A window without a name
counts for no other family if the notices of one that the paragraph names
explain it as well.

The training set is built here from the notices below and, for the class
``unknown``, from a bounded sample of the documents' own paragraphs; ``SAMPLES``
variants of each notice and ``BACKGROUND`` paragraphs bound the fit.  Every fifth
notice is held out with all its variants, so the temperature is set on notices
that training has not seen.  Every paragraph of every text is classified, with
all weights in one small array.

Null, empty and wordless texts have no paragraphs.  A paragraph's windows grow with its
names and notices, and time with its windows, whatever its length; names that repeat
have equal windows, which are classified once.  Ties between families go
to the first by name.  Repeated rows give repeated results; an empty table
gives an empty result.  Added columns take the place of input columns with
their names.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import batches, textvec as tv

UNKNOWN = "unknown"
#: Variants of each notice in the training set.
SAMPLES = 6
#: Paragraphs of the documents in the class ``unknown``, and their code points, at most.
BACKGROUND, BACKGROUND_CHARS = 1000, 400
#: Words before and after a name in the windows around it.
AROUND = [(0, 0), (3, 0), (5, 0), (3, 3), (5, 5), (10, 10), (20, 20), (40, 40)]
#: Words in the windows for notices without a name; they overlap by three quarters.
WINDOWS = [8, 12, 20, 40, 80]
#: Bytes of windows that are classified at once.
AT_ONCE = 1 << 20
#: Families and the names they go by (fixed values).
NAMES = {
    "agpl": ["GNU Affero General Public License", "GNU AGPL", "AGPL 3.0", "AGPLv3"],
    "apache": ["Apache License", "Apache 2.0", "Apache License, Version 2.0", "Apache Software License"],
    "bsd": ["BSD License", "BSD 3-Clause", "BSD 2-Clause", "New BSD License", "Simplified BSD License"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 3.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons Attribution-NonCommercial License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons Attribution-ShareAlike License"],
    "cc0": ["CC0 1.0", "Creative Commons Zero", "CC0 Public Domain Dedication"],
    "epl": ["Eclipse Public License", "EPL 2.0", "Eclipse Public License v2.0"],
    "gpl": ["GNU General Public License", "GNU GPL", "GPL 2.0", "GPL 3.0", "GPLv2", "GPLv3"],
    "isc": ["ISC License"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL", "LGPL 2.1", "LGPL 3.0", "LGPLv3"],
    "mit": ["MIT License", "Expat License", "MIT/X11 License"],
    "mpl": ["Mozilla Public License", "MPL 2.0", "Mozilla Public License, v. 2.0"],
    "proprietary": ["All rights reserved", "Proprietary and confidential", "Unauthorized copying is prohibited", "Tous droits réservés", "Alle Rechte vorbehalten", "Todos los derechos reservados"],
    "unlicense": ["Unlicense", "The Unlicense"],
}
_FRAMES = [
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This software is distributed under the terms of the {}.",
    "SPDX-License-Identifier: {}", "Published under {} by the authors.", "The code is available under the {}.", "This program is free software under the {}, see LICENSE.", "License: {}",
    "Veröffentlicht unter der {}.", "Lizenz: {}", "Sous licence {}.", "Distribué selon les termes de la {}.", "Publicado bajo la {}.", "Licencia: {}",
]
#: Frames of families whose names are whole statements.
_STATEMENTS = {"proprietary": ["{}.", "{}", "Copyright 2021 by the authors. {}.", "© 2019 Example Inc. {}.", "Copyright (c) the publisher, {}.", "(c) 2020. {}. Do not distribute.", "The text belongs to its owner. {}."]}
#: Families whose notices are those of another but for the name.
KIN = {"agpl": "gpl"}
#: Sentences of the licences' own notices (fixed values).
_NOTICES = {
    "apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.", "This work is licensed under the GNU General Public License, version 3."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "unlicense": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
}
#: What is no licence, though some of it sounds like one.
_OTHER = [
    "The driver lost his license after the accident and had to take the test again.", "A fishing license is required on this lake from May to October.", "Copyright law protects original works of authorship.", "Permission from the teacher is needed before leaving the room.",
    "The company was released under the terms of the settlement.", "The public was invited to the general meeting of the foundation.", "The work of the commission is available in the library.", "See the list of conditions in the rental agreement for details.",
    "The right to vote was reserved for citizens.", "All seats were reserved.", "The warranty covers parts and labour for two years.", "The apache helicopter landed near the base.", "She studied at MIT and later taught in Boston.", "Version 2.0 of the plan was published in May.", "The creative team has much in common with the public.",
    "The software was sold to a competitor last year.", "This program is shown every evening at eight.", "Free of charge for children under six years.", "The source of the river lies in the mountains.", "He was granted a day off for personal reasons.", "The eclipse was visible in most of the country.",
    "This page was last edited in the autumn of that year.", "Use of the room is subject to the approval of the board.", "Wir haben das Buch gelesen und darüber gesprochen.", "Le travail de la commission est disponible à la bibliothèque.", "El coche estaba en la calle de la ciudad.", "one two three", "Table of contents", "the of and to in is",
]

#: Paragraphs with these are no background.
_SUSPECT = r"(?i)licen[cs]|lizenz|copyright|rights reserved|derechos|rechte|droits|permission|public domain|redistribut|gpl|\(c\)|©"

_ALNUM = np.ones(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, their texts, bigram hashes, their texts)."""
    low = tv.LOWER[data]
    starts, ends, owner = tv.words(low, off, _ALNUM)
    h = tv.span_hash(low, starts, ends)
    same = owner[1:] == owner[:-1]
    pair = tv.mix(h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:])[same]
    return h, owner, pair, owner[:-1][same]


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)


def training_set(seed: int = 7, background: tuple[str, ...] = ()) -> tuple[list[str], list[str], list[int]]:
    """Variants of the notices with words lost, swapped for others or cut off, their
    families, and the number of the notice that each is made from."""
    rng = np.random.default_rng(seed)
    filler = " ".join(_OTHER).split()
    texts, labels, origin = [], [], []
    number = 0
    for family in sorted(NAMES):
        notices = [f.format(n) for n in NAMES[family] for f in _STATEMENTS.get(family, _FRAMES)] + _NOTICES.get(family, [])
        for notice in notices:
            number += 1
            words = notice.split()
            for i in range(SAMPLES * (4 if notice in _NOTICES.get(family, []) else 1)):
                own = list(words)
                if i and len(own) > 12:
                    a = rng.integers(0, len(own) // 3)
                    own = own[a : a + max(10, int(len(own) * rng.uniform(0.5, 1)))]
                if i > 1:
                    own = [*rng.choice(filler, rng.integers(0, 4)).tolist(), *own, *rng.choice(filler, rng.integers(0, 6)).tolist()]
                texts.append(" ".join(own))
                labels.append(family)
                origin.append(number)
    for _ in range(SAMPLES * 40):
        for s in (_OTHER[rng.integers(len(_OTHER))], " ".join(rng.choice(filler, rng.integers(1, 30)))):
            number += 1
            texts.append(s)
            labels.append(UNKNOWN)
            origin.append(number)
    texts += background
    labels += [UNKNOWN] * len(background)
    origin += range(number + 1, number + 1 + len(background))
    return texts, labels, origin


def background(docs: DataFrame, text: str = "text", most: int = BACKGROUND) -> tuple[str, ...]:
    """A sample of paragraphs, one of each text at most, those first by hash; none that
    may speak of a licence.  ``most`` rows reach the driver."""
    lines = F.split(F.col(text), "\n")
    one = F.substring(F.get(lines, F.pmod(F.xxhash64(text), F.size(lines)).cast("int")), 1, BACKGROUND_CHARS)
    found = docs.select(one.alias("p")).where(F.col("p").rlike(r"\S+\s+\S+\s+\S") & ~F.col("p").rlike(_SUSPECT)).groupBy("p").agg(F.count("*").alias("n"))
    return tuple(r["p"] for r in found.orderBy(F.xxhash64("p"), "p").limit(most).select("p").collect())


@dataclass
class Model:
    families: list[str]
    keys: np.ndarray  # sorted n-gram hashes
    weights: np.ndarray  # (n-grams + 2, families): then the share of unseen n-grams, and the bias
    names: dict[str, list[str]]
    notices: dict[str, np.ndarray]  # sorted bigram hashes
    temperature: float

    def features(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, feature, value) triples of known n-grams, and each text's share of unseen ones (-1: no word)."""
        h, ho, b, bo = _grams(data, off)
        key, owner = np.concatenate([h, b]), np.concatenate([ho, bo])
        total = np.bincount(owner, minlength=len(off) - 1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        owner, at = owner[known], at[known]
        value = 1 / np.sqrt(np.maximum(total, 1))[owner]
        unseen = np.where(total > 0, 1 - np.bincount(owner, minlength=len(total)) / np.maximum(total, 1), -1)
        return owner, at, value, unseen

    def probabilities(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        owner, at, value, unseen = self.features(data, off)
        z = np.outer(np.maximum(unseen, 0), self.weights[-2]) + self.weights[-1]
        for c in range(len(self.families)):
            z[:, c] += np.bincount(owner, value * self.weights[at, c], minlength=len(z))
        z = z / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[unseen < 0] = 0
        return p

    def spelled(self, w: Words) -> list[tuple[str, int, np.ndarray]]:
        """(family, words, where it starts) of every name, places in order."""
        out = []
        for family, own in self.names.items():
            for name in own:
                k = _grams(*_flat([name]))[0]
                at = np.flatnonzero(w.h == k[0])
                at = at[at + len(k) <= len(w.h)]
                for d in range(1, len(k)):
                    at = at[w.h[at + d] == k[d]]
                at = at[w.owner[at] == w.owner[at + len(k) - 1]] if len(at) else at
                out.append((family, len(k), at))
        return out

    def windows(self, w: Words, spelled: list[tuple[str, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(first word, word after the last) of every window in which a family can be confirmed, each once."""
        firsts, lasts = [], []
        for _, k, at in spelled:
            low, high = w.edge[w.owner[at]], w.edge[w.owner[at] + 1]
            for x, y in AROUND:
                firsts.append(np.maximum(low, at - x))
                lasts.append(np.minimum(high, at + k + y))
        some = np.r_[0, np.cumsum(np.isin(w.pair, np.concatenate([*self.notices.values()])))]
        for size in WINDOWS:
            step = size // 4
            count = -(-np.maximum(np.diff(w.edge) - size, 0) // step) * (np.diff(w.edge) > size)
            first = np.repeat(w.edge[:-1], count + 1) + (tv.gather(np.zeros(len(count), np.int64), count + 1) * step)
            own = np.repeat(np.arange(len(count)), count + 1)
            first = np.maximum(np.minimum(first, w.edge[own + 1] - size), w.edge[own])
            last = np.minimum(first + size, w.edge[own + 1])
            few = last - first >= 7
            first, last = first[few], last[few]
            ok = some[last - 1] - some[first] >= 0.6 * (last - first - 1) - 1e-9
            firsts.append(first[ok])
            lasts.append(last[ok])
        key = np.unique(np.concatenate(firsts) * (len(w.h) + 1) + np.concatenate(lasts))
        return key // (len(w.h) + 1), key % (len(w.h) + 1)

    def window_probabilities(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Those of the byte spans [a, b): equal texts once, some ``AT_ONCE`` bytes at a time."""
        _, one, back = np.unique(tv.span_hash(data, a, b), return_index=True, return_inverse=True)
        a, size = a[one], (b - a)[one]
        out = np.zeros((len(one), len(self.families)))
        cut = np.r_[0, np.cumsum(size)] // AT_ONCE
        edge = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(one)]
        for i, j in itertools.pairwise(edge):
            if j > i:
                out[i:j] = self.probabilities(data[tv.gather(a[i:j], size[i:j])], np.r_[0, np.cumsum(size[i:j])])
        return out[back]

    def claims(self, data: np.ndarray, off: np.ndarray, whole: np.ndarray, least: float) -> dict[int, dict[str, float]]:
        """The families of each text and their probabilities, from its windows and from the
        probabilities ``whole`` of the text itself.

        Names and bigrams of notices are counted by running sums and sorted places, so that a
        window costs the same wherever it lies; only windows without a name are gone through
        one by one, each against the merged spans taken before.
        """
        w = Words(data, off)
        if not len(w.h):
            return {}
        spelled = self.spelled(w)
        first, last = self.windows(w, spelled)
        size = len(off) - 1
        p = np.r_[whole, self.window_probabilities(data, w.starts[first], w.ends[last - 1])]
        a, b = np.r_[off[:-1], w.starts[first]], np.r_[off[1:], w.ends[last - 1]]
        owner = np.r_[np.arange(size), w.owner[first]]
        first, last = np.r_[w.edge[:-1], first], np.r_[w.edge[1:], last]
        best = p.argmax(1)
        row = np.flatnonzero((best != len(self.families) - 1) & (p.max(1) >= least))
        owner, a, b, first, last, best, p = owner[row], a[row], b[row], first[row], last[row], best[row], p[row, best[row]]
        pairs = np.maximum(last - first - 1, 0)
        families = self.families[:-1]
        share = np.zeros((len(row), len(families)))  # of a window's bigrams, those that stand in a family's notices
        for c, family in enumerate(families):
            if len(self.notices[family]):
                upto = np.r_[0, np.cumsum(np.isin(w.pair, self.notices[family]))]
                share[:, c] = (upto[np.maximum(last - 1, first)] - upto[first]) / np.maximum(pairs, 1)
        named = np.zeros(len(row), bool)
        for family, k, at in spelled:
            mine = np.flatnonzero(best == families.index(family))
            named[mine] |= np.searchsorted(at, first[mine]) < np.searchsorted(at, last[mine] - k + 1)
        own = share[np.arange(len(row)), best]
        kin = share[:, [families.index(KIN.get(f, f)) for f in families]]  # a family's notices, or those that it shares
        ok = named | (pairs >= 6) & (own >= 0.6)
        out: dict[int, dict[str, float]] = {}
        told: dict[int, np.ndarray] = {}  # the families that a text names
        for i in np.flatnonzero(ok & named).tolist():
            mine, family = out.setdefault(int(owner[i]), {}), families[best[i]]
            mine[family] = max(mine.get(family, 0.0), float(p[i]))
            told.setdefault(int(owner[i]), np.zeros(len(families), bool))[best[i]] = True
        held: dict[tuple[int, int], Spans] = {}
        rest = np.flatnonzero(ok & ~named)
        explained = kin[np.arange(len(row)), best] * pairs
        for i in rest[np.lexsort((best[rest], b[rest], a[rest], -p[rest], -explained[rest], owner[rest]))].tolist():
            text, family = int(owner[i]), int(best[i])
            rivals = told.get(text)
            if rivals is not None and (rivals & (kin[i] >= 0.6) & (np.arange(len(families)) != family)).any():
                continue
            if any(held[text, c].meets(a[i], b[i]) for c in range(len(families)) if c != family and (text, c) in held):
                continue
            held.setdefault((text, family), Spans()).add(int(a[i]), int(b[i]))
            mine = out.setdefault(text, {})
            mine[families[family]] = max(mine.get(families[family], 0.0), float(p[i]))
        return out


class Spans:
    """Disjoint spans in order, merged where they touch."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, a: int, b: int) -> bool:
        i = bisect.bisect_right(self.ends, a)
        return i < len(self.ends) and self.starts[i] < b

    def add(self, a: int, b: int) -> None:
        i, j = bisect.bisect_left(self.ends, a), bisect.bisect_right(self.starts, b)
        if i < j:
            a, b = min(a, self.starts[i]), max(b, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [a], [b]


class Words:
    """Words of some texts: places, hashes, texts, each text's bounds, and the hash of each word with the next (0 across texts)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = tv.LOWER[data]
        self.starts, self.ends, self.owner = tv.words(low, off, _ALNUM)
        self.h = tv.span_hash(low, self.starts, self.ends)
        self.edge = tv.runs(self.owner, len(off) - 1)
        pair = tv.mix(self.h[:-1] * np.uint64(0x9FB21C651E98DF25) + self.h[1:])
        self.pair = np.where(self.owner[1:] == self.owner[:-1], pair, np.uint64(0))


@functools.lru_cache(4)
def fit(background: tuple[str, ...] = (), steps: int = 120, rate: float = 2.0, decay: float = 1e-4) -> Model:
    """Train on four fifths of the notices, set the temperature on the others."""
    texts, labels, origin = training_set(background=background)
    families = [*sorted(NAMES), UNKNOWN]
    y = np.array([families.index(label) for label in labels])
    held = np.array(origin) % 5 == 4
    h, _, b, _ = _grams(*_flat(texts))
    norm = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower()))
    names = {f: [f" {norm(n)} " for n in ns] for f, ns in NAMES.items()}
    notices = {f: np.unique(_grams(*_flat(_NOTICES[f]))[2]) if f in _NOTICES else np.zeros(0, np.uint64) for f in NAMES}
    keys, often = np.unique(np.concatenate([h, b]), return_counts=True)
    keys = keys[often > 1]  # what is seen once counts as unseen, here as later
    model = Model(families, keys, np.zeros((len(keys) + 2, len(families))), names, notices, 1.0)
    owner, at, value, unseen = model.features(*_flat(texts))
    unseen = np.maximum(unseen, 0).astype(np.float32)
    # some rows of unseen n-grams only, so that these point to the unknown class
    blank = np.linspace(0.3, 1, len(y) // 8).astype(np.float32)
    place = np.cumsum(~held) - 1
    mine = ~held[owner]
    row, feature, v = place[owner[mine]], at[mine], value[mine].astype(np.float32)[:, None]
    share_unseen, goal = np.r_[unseen[~held], blank], np.r_[y[~held], np.full(len(blank), families.index(UNKNOWN))]
    onehot = np.eye(len(families), dtype=np.float32)[goal]
    weight = 1 / np.bincount(goal, minlength=len(families))[goal]
    weight = (np.sqrt(weight) / np.sqrt(weight).sum()).astype(np.float32)[:, None]
    # sums over sparse entries: by row for scores, by feature for slopes
    by_row, by_feature = np.argsort(row, kind="stable"), np.argsort(feature, kind="stable")
    rows, row_starts = np.unique(row[by_row], return_index=True)
    features, feature_starts = np.unique(feature[by_feature], return_index=True)
    v_row, f_row, v_feature, r_feature = v[by_row], feature[by_row], v[by_feature], row[by_feature]
    w = np.zeros(model.weights.shape, np.float32)
    pace = np.zeros_like(w)
    for _ in range(steps):  # gradient descent with momentum
        z = np.outer(share_unseen, w[-2]) + w[-1]
        z[rows] += np.add.reduceat(v_row * w[f_row], row_starts)
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        off = (p - onehot) * weight
        slope = decay * w
        slope[features] += np.add.reduceat(v_feature * off[r_feature], feature_starts)
        slope[-2] += share_unseen @ off
        slope[-1] += off.sum(0)
        pace = 0.9 * pace - rate * slope
        w += pace
    model.weights = w.astype(float)
    z = np.outer(unseen, w[-2]) + w[-1]
    np.add.at(z, owner, value.astype(np.float32)[:, None] * w[at])
    z = z[held]
    losses = []
    for temperature in (grid := np.geomspace(0.05, 4, 40)):
        q = z / temperature
        losses.append((np.log(np.exp(q - q.max(1, keepdims=True)).sum(1)) + q.max(1) - q[np.arange(len(q)), y[held]]).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    return model


FOUND = T.ArrayType(T.StructType([T.StructField("family", T.StringType()), T.StructField("line", T.LongType()), T.StructField("probability", T.DoubleType())]))


def scan(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add ``n_paragraphs`` and ``licenses``: family, line number (from 0) and
    calibrated probability of every family that claims a paragraph or a part of it."""
    shared = batches.shared(docs, fit(background(docs, text)))
    schema, keep = batches.extended(docs, [T.StructField("n_paragraphs", T.LongType()), T.StructField("licenses", FOUND)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for whole in parts:
            raw, off = tv.buffers(whole.column(text))
            for i, j in tv.blocks(off):
                data, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
                feed = np.flatnonzero(data == 10)
                edge = np.unique(np.r_[at, feed + 1])
                edge = edge[edge <= len(data)]
                owner = np.searchsorted(at, edge[:-1], "right") - 1
                number = np.searchsorted(feed, edge[:-1]) - np.searchsorted(feed, at[owner])
                p = model.probabilities(data, edge) if len(edge) > 1 else np.zeros((0, len(model.families)))
                found: list[list[dict]] = [[] for _ in range(j - i)]
                claims = model.claims(data, edge, p, least) if len(edge) > 1 else {}
                for row in sorted(claims):
                    for family in sorted(claims[row]):
                        found[owner[row]].append({"family": family, "line": int(number[row]), "probability": round(claims[row][family], 6)})
                worded = np.bincount(owner[p.sum(1) > 0], minlength=j - i) if len(p) else np.zeros(j - i, np.int64)
                kind = pa.list_(pa.struct([("family", pa.string()), ("line", pa.int64()), ("probability", pa.float64())]))
                yield batches.with_columns(whole.slice(i, j - i), keep, {"n_paragraphs": pa.array(worded, pa.int64()), "licenses": pa.array(found, kind)})

    return batches.mapped(docs, run, schema)
