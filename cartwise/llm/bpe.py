"""Byte-level BPE encoding and decoding with a pair occurrence index.

Texts are cut into pre-tokens by the public byte-level pattern. The distinct
pre-tokens of a partition that are not known yet are merged together: an index
maps every adjacent pair that has a rank to all its positions, and the active
ranks are applied in ascending order, each at all of its positions at once; a
merge updates the lists of the pairs it creates. A pair made by the merge of rank
r contains the new token, so its rank is higher than r and the ascending order is
the order that merging each pre-token alone would follow. One very long pre-token
costs n log n, not n squared.

Work is map-only: no shuffle, no state beyond one partition's pre-token cache
(bounded by ``CACHE_SIZE`` entries; it is emptied when full, which only costs
time).

Defined results: null texts are empty; empty texts have no tokens; the strings of
added tokens inside a text become their ids, as the tokenizers library does by
default; ids without a token are skipped when decoding; bytes that are not UTF-8
decode to U+FFFD; repeated rows are encoded alike; extra columns of the input are
kept by ``encode`` and ``decode``, which replace only the columns they write.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartwise.llm.common import slices

#: Fixed value: the public byte-level pre-token pattern, with white space as the
#: Unicode property (the library's meaning of ``\s``).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE_SIZE = 500_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ranks, ids and token bytes read from a tokenizer's JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.byte_ids = [0] * 256
        for letter, value in letters.items():
            self.byte_ids[value] = vocab[letter]
        self.ranks, self.made = {}, []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append((vocab[a], vocab[b], vocab[a + b]))
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: self._bytes(t, letters) for t, i in vocab.items()}
        self.tokens |= {i: self._bytes(t, letters) for t, i in self.added.items()}

    @staticmethod
    def _bytes(token: str, letters: dict[str, int]) -> bytes:
        return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


def merge_together(words: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """The ids of each word, all words merged through one pair occurrence index."""
    ranks, made = vocab.ranks, vocab.made
    symbols: list[int] = []
    following: list[int] = []
    starts: list[int] = []
    for word in words:
        starts.append(len(symbols))
        symbols += [vocab.byte_ids[b] for b in word]
        following += range(len(following) + 1, len(symbols))
        if word:
            following.append(-1)
    before = [-1] * len(symbols)
    index: dict[int, list[int]] = {}
    for p, q in enumerate(following):
        if q >= 0:
            before[q] = p
            rank = ranks.get(symbols[p] << 32 | symbols[q])
            if rank is not None:
                index.setdefault(rank, []).append(p)
    active = list(index)
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        left, right, new = made[rank]
        positions = index.pop(rank)
        positions.sort()  # leftmost first where a pair overlaps itself
        for p in positions:
            q = following[p]
            if q < 0 or symbols[p] != left or symbols[q] != right:
                continue  # an earlier merge took one of the two
            n = following[q]
            symbols[p], symbols[q], following[p], following[q] = new, -1, n, -1
            k = before[p]
            if k >= 0:
                r = ranks.get(symbols[k] << 32 | new)
                if r is not None:
                    if r in index:
                        index[r].append(k)
                    else:
                        index[r] = [k]
                        heapq.heappush(active, r)
            if n >= 0:
                before[n] = p
                r = ranks.get(new << 32 | symbols[n])
                if r is not None:
                    if r in index:
                        index[r].append(p)
                    else:
                        index[r] = [p]
                        heapq.heappush(active, r)
    out = []
    for word, p in zip(words, starts):
        ids = []
        while word and p >= 0:
            ids.append(symbols[p])
            p = following[p]
        out.append(ids)
    return out


class Encoder:
    """Encodes texts with one cache of known pre-tokens."""

    def __init__(self, vocab: Vocabulary, cache_size: int = CACHE_SIZE):
        self.vocab, self.cache_size = vocab, cache_size
        self.known: dict[str, bytes] = {}
        self.cut = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(
            regex.escape(t) for t in sorted(vocab.added, key=len, reverse=True))) if vocab.added else None

    def _tokens(self, text: str) -> list[str | int]:
        if self.special is None or not self.special.search(text):
            return self.cut(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.cut(text[at:m.start()])
            out.append(self.vocab.added[m.group()])
            at = m.end()
        return out + self.cut(text[at:])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._tokens(t or "") for t in texts]
        if len(self.known) > self.cache_size:
            self.known.clear()
        new: set = set()
        for tokens in cut:
            new.update(tokens)
        new = [t for t in new if t not in self.known]
        plain = [t for t in new if isinstance(t, str)]
        for token, ids in zip(plain, merge_together([t.encode("utf-8") for t in plain], self.vocab)):
            self.known[token] = np.array(ids, "<u4").tobytes()
        for token in new:
            if not isinstance(token, str):
                self.known[token] = np.array([token], "<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, tokens)) for tokens in cut]


def _replaced(batch, name: str, values, kind) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(values, kind)], [*names, name])


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def load(spark, path: str):
    """The tokenizer file's text as a broadcast (one vocabulary file, a few MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
           cache_size: int = CACHE_SIZE) -> DataFrame:
    """``df`` with ``ids_col``: the token ids as little-endian unsigned 32-bit integers
    (binary). ``path`` is the tokenizer file on the driver; its text is broadcast."""
    source = load(df.sparkSession, path)

    def run(batches):
        encoder = Encoder(Vocabulary(source.value), cache_size)
        for batch in batches:
            for part in slices(batch, text_col):
                yield _replaced(part, ids_col, encoder.encode(part.column(text_col).to_pylist()), pa.binary())

    return df.mapInArrow(run, _schema_with(df, ids_col, T.BinaryType()))


def _text(ids: bytes | None, tokens: dict[int, bytes]) -> str:
    got = map(tokens.get, np.frombuffer(ids or b"", "<u4").tolist())
    return b"".join(t for t in got if t is not None).decode("utf-8", "replace")


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of the ids, special tokens included."""
    source = load(df.sparkSession, path)

    def run(batches):
        tokens = Vocabulary(source.value).tokens
        for batch in batches:
            for part in slices(batch, ids_col):
                yield _replaced(part, text_col, [_text(ids, tokens) for ids in part.column(ids_col).to_pylist()], pa.string())

    return df.mapInArrow(run, _schema_with(df, text_col, T.StringType()))


def round_trip(df: DataFrame, path: str, text_col: str = "text", cache_size: int = CACHE_SIZE) -> DataFrame:
    """``df`` with ``ids``, ``n_tokens`` and ``decoded``: what ``encode`` and then ``decode``
    give, in one Python worker a task with one vocabulary, so that texts and ids do not
    travel to a second one."""
    source = load(df.sparkSession, path)
    out = T.StructType([f for f in df.schema.fields if f.name not in ("ids", "n_tokens", "decoded")]
                       + [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
                          T.StructField("decoded", T.StringType())])

    def run(batches):
        vocab = Vocabulary(source.value)
        encoder = Encoder(vocab, cache_size)
        for batch in batches:
            for part in slices(batch, text_col):
                ids = encoder.encode(part.column(text_col).to_pylist())
                part = _replaced(part, "ids", ids, pa.binary())
                part = _replaced(part, "n_tokens", [len(i) // 4 for i in ids], pa.int64())
                yield _replaced(part, "decoded", [_text(i, vocab.tokens) for i in ids], pa.string())

    return df.mapInArrow(run, out)
