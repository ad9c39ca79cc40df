"""Byte-pair encoding and decoding with a fixed public vocabulary.

Method: the distinct words of a block of texts are laid out as symbols in one
flat array.  Each round finds every pair's rank by binary search over the
sorted pair keys, takes each word's lowest rank, and merges its occurrences
for all words together.  Finished words leave the array.  Only words not seen
before are encoded; a bounded cache holds the rest.

Nulls count as empty texts and give no tokens.  Ties (several occurrences of
the lowest pair) merge from the left.  Repeated rows give repeated results,
empty tables an empty result.  Added columns take the place of input columns
with their names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from . import batches, textvec as tv

_WS = regex.compile(r"\s+")
END = "</w>"
_NONE = np.int32(2**31 - 1)
#: Words and their characters that a worker keeps encoded at most.
CACHE_WORDS, CACHE_CHARS = 200_000, 4_000_000
#: Characters whose words are held as Python strings at once.
PIECE_CHARS = 1_000_000


#: Fixed values of the vocabulary's published pre-tokenisation, and of Unicode:
#: letters and numbers newer than Unicode 16, which are neither to the tokenizers
#: library, and capitals of Unicode 16 and 17, which unicodedata does not know yet.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|{other}+"
_LATE = (
    "558, 58B-58C, 88F, C5C, CDC, 208F, 209D-209F, A7CE-A7CF, A7D2, A7D4, A7DD, A7E2, A7F1, AB6C-AB6D, 107BB-107BF, "
    "10940-10959, 10EC5-10EC7, 10ED9-10EEE, 11B0A, 11DB0-11DDB, 11DF1, 16EA0-16EB8, 16EBB-16ED3, 16FF2-16FF3, "
    "187F8-187FF, 18CD6-18CDA, 18D09-18D20, 18D80-18DF2, 18E00-19191, 191A0-191D2, 1B123-1B128, 1B168, 1D6A6, "
    "1DF1F-1DF24, 1DF2B-1DF81, 1DF90-1DF96, 1DFCD-1DFFF, 1E6C0-1E6DE, 1E6E0-1E6E2, 1E6E4-1E6E5, 1E6E7-1E6ED, "
    "1E6F0-1E6F4, 1E6FE-1E6FF, 2B73A-2B73F, 2B81E, 2CEA2-2CEAD, 323B0-33479, 3D000-3FC3F"
)
_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}

_late = "".join("-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in _LATE.split(", "))
_RARE = regex.compile(rf"[{_late}{''.join(map(chr, _CAPITALS))}]")
_WORD = regex.compile(_PATTERN.format(letter=r"\p{L}", number=r"\p{N}", other=r"[^\s\p{L}\p{N}]"))
_WORD_RARE = regex.compile(_PATTERN.format(letter=rf"[\p{{L}}--[{_late}]]", number=rf"[\p{{N}}--[{_late}]]", other=rf"(?:[^\s\p{{L}}\p{{N}}]|[{_late}])"), regex.V1)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that
    print stand for themselves, the others take code points from 256 on in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class Codec:
    """Tables of one vocabulary; picklable, a few MB whatever the corpus."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: w for w, i in vocab.items()} | {i: w for w, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + END] for c in letters], np.int32)
        left, right, made = [], [], []
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        key = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), np.array(made, np.int32)
        # A rank whose product takes part in an earlier merge could change the
        # order within a round; such ranks merge one occurrence at a time.
        first = np.full(len(self.names), _NONE, np.int64)
        at = np.arange(len(made))
        np.minimum.at(first, np.array(left), at)
        np.minimum.at(first, np.array(right), at)
        self.careful = first[self.made] <= at

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def encode_words(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of non-empty words, in their order."""
        raw = [w.encode() for w in items]
        data = np.frombuffer(b"".join(raw), np.uint8)
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        sym, word = self.inner[data], np.repeat(np.arange(len(raw)), lens)
        tail = np.cumsum(lens) - 1
        sym[tail] = self.last[data[tail]]
        rank = np.full(len(sym), _NONE, np.int32)
        if len(sym) > 1:
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same] = self._rank(sym[same], sym[same + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(sym)])
            low = np.minimum.reduceat(rank, starts)
            over = low == _NONE
            if over.any():
                out = np.repeat(over, size)
                done.append((word[out], sym[out]))
                sym, word, rank = sym[~out], word[~out], rank[~out]
                low, size = low[~over], size[~over]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            # overlapping occurrences (a pair of equal symbols): every other one
            fresh = np.r_[True, np.diff(hit) != 1]
            run = np.flatnonzero(fresh)
            place = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
            hit = hit[place % 2 == 0]
            slow = self.careful[rank[hit]]
            if slow.any():
                lead = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
                hit = hit[lead | ~slow]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            rank[hit] = _NONE
            place = np.cumsum(keep) - 1
            sym, word, rank, hit = sym[keep], word[keep], rank[keep], place[hit]
            for at in (hit, hit - 1):
                at = at[(at >= 0) & (at < len(sym) - 1)]
                joined = word[at] == word[at + 1]
                rank[at[~joined]] = _NONE
                at = at[joined]
                rank[at] = self._rank(sym[at], sym[at + 1])
            rank[-1] = _NONE
        if not done:
            return np.zeros(0, np.int32), lens
        owner = np.concatenate([w for w, _ in done])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([s for _, s in done])[order], np.bincount(owner, minlength=len(raw))

    def words(self, text: str) -> list[str]:
        """Pre-tokenised words of a text; special tokens stand as themselves."""
        if any(s in text for s in self.special):
            cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            return [w for i, part in enumerate(cut.split(text)) for w in ([part] if i % 2 else _plain(part))]
        return _plain(text)

    def encoder(self) -> Encoder:
        return Encoder(self)

    def decode(self, ids: np.ndarray) -> str:
        """Token strings joined by spaces, as the library does without a decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _plain(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    text = _WS.sub(" ", text)
    if "Σ" in text:  # lower() has a rule for the last letter of a word; the vocabulary hasn't
        text = text.replace("Σ", "σ")
    if not text.isascii() and _RARE.search(text):
        return _WORD_RARE.findall(text.translate(_CAPITALS).lower())
    return _WORD.findall(text.lower())


class Encoder:
    """Encodes texts, keeping a bounded number of words encoded."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self._reset()

    def _reset(self) -> None:
        self.known = {s: i for i, s in enumerate(self.codec.special)}
        self.ids = [np.array(list(self.codec.special.values()), np.int32)]
        self.lens = [np.ones(len(self.known), np.int64)]
        self.chars = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, bounds) of texts."""
        flat: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= PIECE_CHARS):
                chars += len(texts[j])
                j += 1
            per = [self.codec.words(t) for t in texts[i:j]]
            every = [w for ws in per for w in ws]
            new = list(dict.fromkeys(w for w in every if w not in self.known))
            if new and (len(self.known) + len(new) > CACHE_WORDS or self.chars > CACHE_CHARS):
                self._reset()
                new = list(dict.fromkeys(w for w in every if w not in self.known))
            if new:
                ids, lens = self.codec.encode_words(new)
                at = len(self.known)
                self.known.update(zip(new, range(at, at + len(new)), strict=True))
                self.ids.append(ids)
                self.lens.append(lens)
                self.chars += sum(map(len, new))
            if len(self.ids) > 1:
                self.ids, self.lens = [np.concatenate(self.ids)], [np.concatenate(self.lens)]
            place = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
            starts = np.cumsum(self.lens[0]) - self.lens[0]
            size = self.lens[0][place]
            flat.append(self.ids[0][tv.gather(starts[place], size)])
            edge = np.r_[0, np.cumsum(np.fromiter(map(len, per), np.int64, j - i))]
            counts[i:j] = np.diff(np.r_[0, np.cumsum(size)][edge])
            i = j
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), np.r_[0, np.cumsum(counts)]


def encode(df: DataFrame, path: str, text: str = "text", packed: bool = False, decoded: bool = False) -> DataFrame:
    """Add ``n_tokens`` and ``token_ids`` of the column ``text``.

    ``packed`` gives the ids as little-endian 32-bit binary instead of an
    array; ``decoded`` adds ``decoded``, their decoding, in the same pass.
    """
    tables = batches.shared(df, Codec(path))
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))]
    more += [T.StructField("decoded", T.StringType())] * decoded
    schema, keep = batches.extended(df, more)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: Codec = tables.value
        encoder = codec.encoder()
        for whole in parts:
            for batch in batches.slices(whole, text):
                ids, bounds = encoder.encode(batches.texts(batch.column(text)))
                cut = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                out = {"n_tokens": pa.array(np.diff(bounds), pa.int64())}
                out["token_ids"] = pa.array([x.astype("<u4").tobytes() for x in cut], pa.binary()) if packed else pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                if decoded:
                    out["decoded"] = pa.array([codec.decode(x) for x in cut], pa.string())
                yield batches.with_columns(batch, keep, out)

    return batches.mapped(df, run, schema)


def decode(df: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """Add ``decoded``, the text of an array of token ids; null counts as none."""
    tables = batches.shared(df, Codec(path))
    schema, keep = batches.extended(df, [T.StructField("decoded", T.StringType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec: Codec = tables.value
        for batch in parts:
            out = [codec.decode(np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
            yield batches.with_columns(batch, keep, {"decoded": pa.array(out, pa.string())})

    return batches.mapped(df, run, schema)
