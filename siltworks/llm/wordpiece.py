"""Greedy word-piece token counts by a linear longest-match automaton.

Method: the vocabulary is a trie whose nodes have failure links and the count
of tokens that a failure pops.  Reading a word, the automaton follows its next
symbol; where the trie has no edge it adds the node's popped count and goes to
its failure link.  The count of pieces comes out without building a piece, in
time linear in the word (after Song et al., "Fast WordPiece Tokenization").

Words are those of the vocabulary's own pre-tokenisation.  A piece is the longest
vocabulary string at its place; strings that the vocabulary marks as a word's
end count at its end only, the others before it: a word's last byte is a symbol
of its own.  Many words step through the automaton together; the few of more
than ``LONG`` bytes go one by one, in time linear in their length.

A null text counts as empty: no words, no pieces.  Ties cannot occur, as one
string is longest.  Repeated rows give repeated results, empty tables an empty
result.  Added columns take the place of input columns with their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from . import batches, bpe


#: Bytes of a word up to which words go together.
LONG = 256
#: Symbols: 256 bytes, and the same as last ones of a word.
SYMBOLS = 512


class Automaton:
    """Trie over symbols; edges as one sorted array of keys."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        nodes: dict[tuple[int, int], int] = {}
        depth, parent, via = [0], [0], [0]
        final = {}
        for piece in pieces:
            at = 0
            for symbol in piece:
                nxt = nodes.get((at, symbol))
                if nxt is None:
                    nxt = nodes[at, symbol] = len(depth)
                    depth.append(depth[at] + 1)
                    parent.append(at)
                    via.append(symbol)
                at = nxt
            final[at] = True
        n = len(depth)
        self.fail, self.popped = np.full(n, -1, np.int32), np.zeros(n, np.int32)
        for v in sorted(range(1, n), key=depth.__getitem__):
            if v in final:
                self.fail[v], self.popped[v] = 0, 1
                continue
            u, count = parent[v], 0
            z, count = self.fail[u], self.popped[u]
            while z >= 0 and (z, via[v]) not in nodes:
                count += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = nodes[z, via[v]], count
        keys = np.fromiter((a * SYMBOLS + b for a, b in nodes), np.int64, len(nodes))
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.fromiter(nodes.values(), np.int32, len(nodes))[order]

    def _next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * SYMBOLS + symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def _one(self, word: bytes) -> int:
        if not hasattr(self, "_edges"):
            self._edges = dict(zip(self.keys.tolist(), self.to.tolist(), strict=True))
            self._links = list(zip(self.fail.tolist(), self.popped.tolist(), strict=True))
        state = total = 0
        for at, byte in enumerate(word, 1):
            symbol = byte + 256 * (at == len(word))
            while (nxt := self._edges.get(state * SYMBOLS + symbol)) is None:
                link, popped = self._links[state]
                if link < 0:
                    return -1
                state, total = link, total + popped
            state = nxt
        while state:
            link, popped = self._links[state]
            if link < 0:
                return -1
            state, total = link, total + popped
        return total

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; -1 for a word the vocabulary cannot spell."""
        every = np.fromiter((self._one(w) if len(w) > LONG else -1 for w in words), np.int64, len(words))
        short = np.flatnonzero(np.fromiter((len(w) <= LONG for w in words), bool, len(words)))
        every[short] = self._together([words[i] for i in short])
        return every

    def _together(self, words: list[bytes]) -> np.ndarray:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lens, kind="stable")
        lens = lens[order]
        data = np.frombuffer(b"".join([words[i] for i in order]), np.uint8).astype(np.int64)
        data[np.cumsum(lens)[lens > 0] - 1] += 256
        starts = np.cumsum(lens) - lens
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.ones(len(words), bool)
        for i in range(int(lens[0]) if len(words) else 0):
            live = int(np.searchsorted(-lens, -i, "left"))  # words with a byte at place i
            who = np.flatnonzero(alive[:live])
            symbol = data[starts[who] + i]
            while len(who):
                nxt = self._next(state[who], symbol)
                ok = nxt >= 0
                state[who[ok]] = nxt[ok]
                who, symbol = who[~ok], symbol[~ok]
                link = self.fail[state[who]]
                lost = link < 0
                alive[who[lost]] = False
                who, symbol, link = who[~lost], symbol[~lost], link[~lost]
                total[who] += self.popped[state[who]]
                state[who] = link
        # what is still unread at the end pops by failures down to the root
        who = np.flatnonzero(alive & (state != 0))
        while len(who):
            link = self.fail[state[who]]
            alive[who[link < 0]] = False
            who, link = who[link >= 0], link[link >= 0]
            total[who] += self.popped[state[who]]
            state[who] = link
            who = who[link != 0]
        total[~alive] = -1
        out = np.empty(len(words), np.int64)
        out[order] = total
        return out


def automaton(codec: bpe.Codec) -> Automaton:
    """The automaton of a byte-level vocabulary with marks for words' ends."""
    byte = {c: b for b, c in enumerate(bpe.byte_letters())}
    special = set(codec.special.values())
    pieces = set()
    for i, name in enumerate(codec.names):
        symbols = [byte[c] for c in name.removesuffix(bpe.END)] if name and i not in special else []
        if symbols:
            pieces.add((*symbols[:-1], symbols[-1] + 256 * name.endswith(bpe.END)))
    return Automaton(sorted(pieces))


def count(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_words`` and ``n_pieces`` of the column ``text``; special tokens count as one piece."""
    codec = bpe.Codec(path)
    tables = batches.shared(df, (codec, automaton(codec)))  # a vocabulary's size, whatever the corpus
    schema, keep = batches.extended(df, [T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, machine = tables.value
        start = dict.fromkeys(own.special, 1)
        known, chars = dict(start), 0
        for whole in parts:
            for batch in batches.slices(whole, text):
                per = [own.words(t) for t in batches.texts(batch.column(text))]
                new = list(dict.fromkeys(w for words in per for w in words if w not in known))
                if new and (len(known) + len(new) > bpe.CACHE_WORDS or chars > bpe.CACHE_CHARS):
                    known, chars = dict(start), 0
                    new = list(dict.fromkeys(w for words in per for w in words if w not in known))
                if new:
                    known.update(zip(new, machine.counts([w.encode() for w in new]).tolist(), strict=True))
                    chars += sum(map(len, new))
                n_words = [len(words) for words in per]
                n_pieces = [sum(map(known.__getitem__, words)) for words in per]
                yield batches.with_columns(batch, keep, {"n_words": pa.array(n_words, pa.int64()), "n_pieces": pa.array(n_pieces, pa.int64())})

    return batches.mapped(df, run, schema)
