"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are normalised (lower case, every run of other characters than letters and
digits becomes one space). An item of m characters that occurs in a text with at
most k edits shares at least m + 1 - q - k q of its q-grams with it, and all of
them on diagonals at most k apart. For every item the q-grams shared with a text
are counted in overlapping diagonal bands of width 2 k + 2 at steps of k + 1, so any
k + 1 neighbouring diagonals lie whole in some band; the bands that reach the bound are
verified by a banded alignment (edit distance of the whole item against the text, at
most k edits), which fills the cells on the band's diagonals and k to either side.

An item of fewer than ``MIN_CHARS`` characters has too few q-grams for the bound. It is
searched with no edits: its words as they are, at word borders, all short items at once.

The items are split into blocks of at most ``ITEM_BYTES`` of text. One block's index is
sent, its matches are written, and the index is dropped before the next, so what is sent
has a fixed bound however large the benchmark is; documents stay where they are and
nothing is shuffled. Long texts are scanned in overlapping windows of ``SCAN_CHARS``.

Defined results: null and empty texts match nothing; an item that is null or has no
letter or digit is not searched; of equally good occurrences the first counts; repeated
items each match under their own id; repeated rows match alike; an empty table on either
side gives no matches; very long texts are held whole in the task that reads them; other
columns are not read by ``matches`` and stay as they are in ``decontaminate``, whatever
their names.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import received, sent, slices, text_key, without, written

Q = 8
#: Edits allowed as a share of an item's normalised length.
EDIT_RATE = 0.1
#: Shorter items are searched without edits.
MIN_CHARS = 32
ITEM_BYTES = 4 << 20
SCAN_CHARS = 1 << 16

_OTHER = re.compile(r"[\W_]+")
_BREAK = re.compile("\0")
MATCH = "id bigint, key bigint, item_id bigint, edits int, start bigint, stop bigint"


def normalised(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def _codes(text: str) -> np.ndarray:
    """The q-grams of ``text`` as 64-bit values, one per start: eight characters,
    each folded to a byte (equal q-grams have equal values; the alignment settles
    the rare unequal ones)."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    folded = ((points * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint64)
    n = len(points) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(Q if n > 0 else 0):
        out = (out << np.uint64(8)) | folded[i:i + n]
    return out


def _slot(codes: np.ndarray, bits: int, odd: int) -> np.ndarray:
    return ((codes * np.uint64(odd)) >> np.uint64(64 - bits)).astype(np.int64)


class ItemIndex:
    """Postings of a block of items: sorted q-grams with (item, position), and two
    bit tables that reject most q-grams of a text before the search."""

    def __init__(self, items: list[tuple[int, str]]):
        items = [(i, t) for i, t in ((i, normalised(t)) for i, t in items) if t]
        self.items = [(i, t) for i, t in items if len(t) >= MIN_CHARS]
        self.short: dict[str, list[int]] = {}
        for i, t in items:
            if len(t) < MIN_CHARS:
                self.short.setdefault(t, []).append(i)
        codes = [_codes(t) for _, t in self.items]
        every = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.grams, self.first = np.unique(every[order], return_index=True)
        self.counts = np.diff(np.append(self.first, len(every)))
        self.item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])[order]
        self.at = (np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64))[order]
        self.m = np.array([len(t) for _, t in self.items], np.int64)
        self.k = (self.m * EDIT_RATE).astype(np.int64)
        self.bound = np.maximum(self.m + 1 - Q - self.k * Q, 1)
        self.bits = max(16, int(np.ceil(np.log2(max(len(self.grams), 1)))) + 5)
        self.table = [np.zeros(1 << self.bits, bool) for _ in range(2)]
        for t, odd in zip(self.table, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
            t[_slot(self.grams, self.bits, odd)] = True

    def bands(self, texts: list[str]):
        """(row, item, first, last): where the item may begin in the text, by the bands that
        reach the bound. The texts are scanned as one string, in overlapping windows."""
        whole = "\0".join(texts)
        ends = np.cumsum([len(t) + 1 for t in texts])
        found: dict[tuple[int, int], list[int]] = {}
        longest = int((self.m + self.k).max(initial=0)) + Q
        for base in range(0, len(whole) if self.items else 0, SCAN_CHARS):
            part = whole[base:base + SCAN_CHARS + longest]
            for item, at, near in self._bands(part):
                row = int(np.searchsorted(ends, at + base, "right"))
                found.setdefault((row, item), []).append(near + base - (int(ends[row]) - len(texts[row]) - 1))
            if base + len(part) >= len(whole):
                break
        for (row, item), near in found.items():
            reach = 2 * (int(self.k[item]) + 1)
            near.sort()
            lo = hi = near[0]
            for n in near[1:]:
                if n - reach > hi + reach:
                    yield row, item, lo - reach, hi + reach
                    lo = n
                hi = n
            yield row, item, lo - reach, hi + reach

    def exact(self, texts: list[str]):
        """(row, text of a short item, end): its first occurrence at word borders."""
        if not self.short:
            return
        if not hasattr(self, "words"):
            self.words = ahocorasick.Automaton()
            for t in self.short:
                self.words.add_word(f" {t} ", t)
            self.words.make_automaton()
        for row, text in enumerate(texts):
            first: dict[str, int] = {}
            for end, t in self.words.iter(f" {text} "):
                first.setdefault(t, end - 1)
            for t, end in first.items():
                yield row, t, end

    def _bands(self, text: str):
        stops = np.array([m.start() for m in _BREAK.finditer(text)], np.int64)
        codes = _codes(text)
        pos = np.flatnonzero(self.table[0][_slot(codes, self.bits, 0x9E3779B97F4A7C15)])
        pos = pos[self.table[1][_slot(codes[pos], self.bits, 0xC2B2AE3D27D4EB4F)]]
        if not len(pos):
            return
        g = np.minimum(np.searchsorted(self.grams, codes[pos]), len(self.grams) - 1)
        hit = self.grams[g] == codes[pos]
        pos, g = pos[hit], g[hit]
        n = self.counts[g]
        total = int(n.sum())
        if not total:
            return
        row = np.repeat(np.arange(len(pos)), n)
        post = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[g], n)
        item, p = self.item[post], pos[row]
        diagonal = p - self.at[post] + int(self.m.max())
        step = self.k[item] + 1
        band = diagonal // step  # each q-gram counts in the bands that start here and one step before
        span = len(text) + int(self.m.max()) * 2 + 2
        key = np.concatenate([item * span + band, item * span + np.maximum(band - 1, 0)])
        where = np.concatenate([p, p])
        gram_at = np.concatenate([self.at[post], self.at[post]])
        keys, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        full = count >= self.bound[keys // span]
        if not full.any():
            return
        chosen = full[inverse]
        key, where, gram_at = key[chosen], where[chosen], gram_at[chosen]
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        for s, e in zip(heads, np.append(heads[1:], len(order))):
            rows = order[s:e]
            it = int(key[rows[0]] // span)
            # distinct item q-grams, not repeated hits of one
            if len(np.unique(gram_at[rows])) < self.bound[it]:
                continue
            starts = where[rows] - gram_at[rows]
            for at, near in _by_text(where[rows], starts, stops):
                yield it, at, near


def _by_text(at: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """For each text that holds some of the hits: one hit's place and the median start."""
    text = np.searchsorted(stops, at)
    for t in np.unique(text):
        mine = text == t
        yield int(at[mine][0]), int(np.median(starts[mine]))


_FAR = np.int64(1 << 40)


def aligned(item: str, text: str, most: int, first: int = 0, last: int | None = None) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of ``item`` that begins in ``text`` at a place
    from ``first`` to ``last`` (any place by default), with at most ``most`` edits, or None;
    of equally good ones the first end. Only the cells on the diagonals first - most to
    last + most are filled: a path with more insertions or deletions has too many edits."""
    n, m = len(text), len(item)
    first, last = max(first, 0), n if last is None else min(last, n)
    if not n or first > last:
        return None
    lo, width = first - most, last - first + 2 * most + 1
    reach = np.arange(width)
    # text characters by diagonal: row i compares item[i - 1] with ahead[i - 1:i - 1 + width]
    ahead = np.zeros(m + width, np.uint32)
    a, b = max(lo, 0), min(lo + m + width, n)
    if a < b:
        ahead[a - lo:b - lo] = np.frombuffer(text[a:b].encode("utf-32-le"), np.uint32)
    at = lo + reach
    row = np.where((at >= first) & (at <= last), 0, _FAR)
    for i, c in enumerate(np.frombuffer(item.encode("utf-32-le"), np.uint32), 1):
        now = row + (ahead[i - 1:i - 1 + width] != c)
        now[at + i < 1] = _FAR
        np.minimum(now[:-1], row[1:] + 1, out=now[:-1])
        now[(at + i < 0) | (at + i > n)] = _FAR
        now = np.minimum.accumulate(now - reach) + reach  # insertions run along the row
        now[at + i > n] = _FAR
        if now.min() > most:
            return None
        row = now
    end = int(row.argmin())
    return (int(row[end]), lo + end + m) if row[end] <= most else None


def _matcher(index):
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                        ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        idx: ItemIndex = received(index)
        for batch in batches:
            rows = []
            for part in slices(batch, "t"):
                ids, keys = part.column("id").to_pylist(), part.column("key").to_pylist()
                texts = [normalised(t) for t in part.column("t").to_pylist()]
                best: dict[tuple, tuple] = {}
                for row, it, lo, hi in idx.bands(texts):
                    got = aligned(idx.items[it][1], texts[row], int(idx.k[it]), lo, hi)
                    if got and ((row, it) not in best or got < best[row, it]):
                        best[row, it] = got
                for (row, it), (edits, stop) in best.items():
                    item, text = idx.items[it][1], texts[row]
                    head = text[max(0, stop - len(item) - edits):stop]
                    back = aligned(item[::-1], head[::-1], edits, 0, 0)  # the same edits, read back from the end
                    rows.append((ids[row], keys[row], idx.items[it][0], edits, stop - back[1], stop))
                for row, item, stop in idx.exact(texts):
                    rows += [(ids[row], keys[row], i, 0, stop - len(item), stop) for i in idx.short[item]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (id, text) of at most ``ITEM_BYTES`` of text each, read one block at a time."""
    rows, size = [], 0
    for r in items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")) \
            .where("t IS NOT NULL").toLocalIterator():
        n = len(r["t"])
        if rows and size + n > ITEM_BYTES:
            yield rows
            rows, size = [], 0
        rows.append((r["i"], r["t"]))
        size += n
    if rows:
        yield rows


def matches(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, key, item_id, edits, start, stop): the best occurrence of each item in each
    text, as a span of the normalised text; ``key`` is of the text."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), text_key(text_col).alias("key"),
                     F.col(text_col).alias("t"))
    out = spark.createDataFrame([], MATCH)
    for block in _item_blocks(items, item_id_col, item_text_col):
        index = ItemIndex(block)
        if not index.items and not index.short:
            continue
        block_sent = sent(spark, index)
        out = out.unionAll(written(docs.mapInArrow(_matcher(block_sent), MATCH), "decontaminate-matches"))
        block_sent.unpersist()
    return out


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text holds an item."""
    return without(df, matches(df, items, id_col, text_col), id_col, text_col)
