"""Ranked lexical search over bit-sliced Bloom signatures.

The index packs documents of like size into blocks. A document's signature is a Bloom
filter over its entries (term, level), an entry for each level of ``LEVELS`` that the
term's count reaches; the block stores the filters by slice, so slice i is the bitmap of
the documents whose filter has bit i. The AND of an entry's slices is a bitmap that holds
every document with the entry and some others: it overestimates presence, and so does
the highest level held overestimate the count.

A query item sums its terms' weights over those bitmaps, level by level, each sum times
what the level can add to a document's term score: an upper bound of its score. The k
largest bounds of an item are scored exactly first; their k-th best (score, id) is the
bar. Then every document whose bound is not provably below the bar is scored exactly from
its text, and the best k are kept. Bounds and scores are integers, so nothing is lost to
rounding, and the outcome is the same for any block, hash or partition.

``build_index`` reads the documents once and knows no query: blocks with slices and texts,
and per block the counts from which N, L and the document frequency of any term are
summed. Items are read in blocks of a bounded number of terms; a block of items is what
is sent to the tasks, and each task keeps k rows per item, however many documents it
reads. Copies of a document cost what their text costs; there is no join of items with
documents.

Defined results: null and empty texts (and texts without a term) are in no block and never
found, items without a known term find nothing; very long texts are blocks of their own;
equal scores go by ascending id, null ids last; repeated rows are documents each; items
that repeat an id are ranked each; empty tables give no rows; other columns are not read,
so they cannot clash.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import binary_values, mixed, pieces, written

#: Bytes of text in a block, and documents.
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 4096
#: Counts of a term that have an entry of their own.
LEVELS = (1, 2, 3, 4, 6, 8, *(n << i for i in range(2, 28) for n in (3, 4)))
#: Bits a filter has for each entry at least, and bits set for an entry.
ENTRY_BITS, PROBES = 10, 4
#: Entries of the smallest filter.
LEAST_ENTRIES = 64
#: Terms whose hashes a task remembers.
KNOWN_TERMS = 1 << 20
#: Items times distinct terms of a block of items.
ITEM_CELLS = 1 << 21
#: Fixed values of the score.
K1_MILLI, B_PERCENT = 8, 75
LAST_ID = np.iinfo(np.int64).max

#: Delimiters become spaces, A-Z lower case; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def term_counts(text: bytes | None) -> Counter:
    out: Counter = Counter()
    for part in pieces((text or b"").translate(_FOLD)):
        out.update(part.split())
    return out


def _positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The slices of entries (term hash, level), one row per probe."""
    h = mixed(hashes + np.uint64((level * 0x9E3779B97F4A7C15) & (2 ** 64 - 1)))
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((a + np.uint64(i) * b) % np.uint64(bits)).astype(np.int64) for i in range(PROBES)])


_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bits", pa.int64()),
                    ("top", pa.int64()), ("slices", pa.binary()), ("texts", pa.list_(pa.string())),
                    ("terms", pa.list_(pa.string())), ("holders", pa.list_(pa.int64()))])
BLOCK_SCHEMA = ("ids array<bigint>, lengths array<bigint>, bits bigint, top bigint, slices binary, texts array<string>, "
                "terms array<string>, holders array<bigint>")


class _Pending:
    """Documents of one size class that wait for their block."""

    def __init__(self, entries: int):
        self.bits = ENTRY_BITS * entries
        self.ids, self.texts, self.hashes, self.counts, self.bytes = [], [], [], [], 0
        self.holders: Counter = Counter()

    def add(self, key, text: bytes, terms: Counter, hashes: np.ndarray, counts: np.ndarray):
        self.ids.append(key)
        self.texts.append(text)
        self.hashes.append(hashes)
        self.counts.append(counts)
        self.holders.update(terms.keys())
        self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.ids) >= BLOCK_ROWS

    def block(self) -> pa.RecordBatch:
        row = np.repeat(np.arange(len(self.ids)), [len(h) for h in self.hashes])
        hashes, counts = np.concatenate(self.hashes), np.concatenate(self.counts)
        grid = np.zeros((self.bits, len(self.ids)), np.uint8)
        for level, least in enumerate(LEVELS):
            has = counts >= least
            if not has.any():
                break
            for at in _positions(hashes[has], level, self.bits):
                grid[at, row[has]] = 1
        lengths = [int(c.sum()) for c in self.counts]
        text = pa.array(self.texts, pa.binary()).view(pa.string())
        terms = pa.array(list(self.holders), pa.binary()).view(pa.string())
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays(
            [one(pa.array(self.ids, pa.int64())), one(pa.array(lengths, pa.int64())), pa.array([self.bits], pa.int64()),
             pa.array([int(counts.max())], pa.int64()), pa.array([np.packbits(grid, axis=1).tobytes()], pa.binary()),
             one(text), one(terms), one(pa.array(list(self.holders.values()), pa.int64()))], schema=_BLOCK)


def _blocks(batches):
    waiting: dict[int, _Pending] = {}
    known: dict[bytes, int] = {}
    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), binary_values(batch.column("text"))):
            terms = term_counts(text)
            if not terms:
                continue
            if len(known) > KNOWN_TERMS:
                known.clear()
            for term in terms:
                if term not in known:
                    known[term] = xxhash.xxh64_intdigest(term)
            hashes = np.fromiter(map(known.__getitem__, terms), np.uint64, len(terms))
            counts = np.fromiter(terms.values(), np.int64, len(terms))
            entries = int(np.searchsorted(LEVELS, counts, "right").sum())
            size = max(LEAST_ENTRIES, 1 << (entries - 1).bit_length())
            own = waiting.setdefault(size, _Pending(size))
            own.add(key, text, terms, hashes, counts)
            if own.full():
                yield waiting.pop(size).block()
    for own in waiting.values():
        yield own.block()


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The blocks of the documents, written once; ``block`` numbers them."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = rows.mapInArrow(_blocks, BLOCK_SCHEMA).withColumn("block", F.monotonically_increasing_id())
    return written(blocks, "search-index")


# ---- items -------------------------------------------------------------------

def _weighed(index: DataFrame, items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """(row, item_id, terms, weights): an item's known terms and their weight times
    their number in it, written; and N and L."""
    facts = index.agg(F.sum(F.size("ids")).alias("n"),
                      F.sum(F.expr("aggregate(lengths, 0L, (s, x) -> s + x)")).alias("l")).first()
    n, total = facts["n"] or 0, facts["l"] or 0

    def split(batches):
        for batch in batches:
            row, terms, times = [], [], []
            for i, text in enumerate(binary_values(batch.column("text"))):
                found = term_counts(text)
                row += [i] * len(found)
                terms += found.keys()
                times += found.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(row, pa.int64())), batch.column("item_id").take(pa.array(row, pa.int64())),
                 pa.array(terms, pa.binary()).view(pa.string()), pa.array(times, pa.int64())],
                names=["row", "item_id", "term", "times"])

    named = written(items.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("item_id"),
                                 F.col(text_col).cast("string").alias("text")), "search-items")
    asked = written(named.mapInArrow(split, "row bigint, item_id bigint, term string, times bigint"), "search-terms")
    held = (index.select(F.explode(F.arrays_zip("terms", "holders")).alias("x")).select("x.terms", "x.holders")
            .join(asked.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
            .groupBy(F.col("terms").alias("term")).agg(F.sum("holders").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("bigint")
    out = asked.join(held, "term").select("row", "item_id", F.struct("term", (weight * F.col("times")).alias("w")).alias("x"))
    return written(out.groupBy("row", "item_id").agg(F.collect_list("x").alias("x")).select(
        "row", "item_id", F.col("x.term").alias("terms"), F.col("x.w").alias("weights")), "search-weights"), n, total


class Items:
    """A block of items as arrays: the weight of each (item, term), and the terms' hashes."""

    def __init__(self, rows: list[tuple[int, list[bytes], list[int]]], n: int, total: int):
        self.rows = np.array([r for r, _, _ in rows], np.int64)
        self.terms = {t: i for i, t in enumerate(sorted({t for _, terms, _ in rows for t in terms}))}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in self.terms], np.uint64)
        self.weights = np.zeros((len(rows), len(self.terms)), np.int64)
        for i, (_, terms, weights) in enumerate(rows):
            self.weights[i, [self.terms[t] for t in terms]] = weights
        exact = np.float32 if self.weights.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
        self.sums = self.weights.astype(exact)  # sums of these are whole numbers that the type holds
        self.n, self.total = n, total

    def part(self, tf, lengths: np.ndarray) -> np.ndarray:
        """What a term that occurs ``tf`` times adds per unit of weight."""
        m = 100 - B_PERCENT + (B_PERCENT * lengths * self.n) // self.total
        return (1_000_000_000 * tf) // (1000 * tf + K1_MILLI * m)

    def bounds(self, slices: np.ndarray, lengths: np.ndarray, top: int) -> np.ndarray:
        """(items x documents) upper bounds of the scores, from the slices alone."""
        out = np.zeros((len(self.rows), len(lengths)), np.int64)
        live, held, before = np.arange(len(self.hashes)), None, 0
        for level, least in enumerate(LEVELS):
            if least > top or not len(live):
                break
            bits = np.bitwise_and.reduce(slices[_positions(self.hashes[live], level, len(slices))], axis=0)
            if held is not None:
                bits &= held
            some = bits.any(axis=1)
            live, held = live[some], bits[some]
            here = np.unpackbits(held, axis=1, count=len(lengths)).astype(self.sums.dtype)
            most = self.part(np.int64(min(LEVELS[level + 1] - 1, top)), lengths)
            out += (self.sums[:, live] @ here).astype(np.int64) * (most - before)
            before = most
        return out

    def scores(self, text: bytes, which: np.ndarray) -> np.ndarray:
        """Exact scores of one document for the chosen items."""
        found = term_counts(text)
        length = np.int64(sum(found.values()))
        here = found.keys() & self.terms.keys()
        at = np.array([self.terms[t] for t in here], np.int64)
        part = self.part(np.array([found[t] for t in here], np.int64), length)
        return self.weights[np.ix_(which, at)] @ part


class _Best:
    """The k best (score, smaller id first) per item of a task."""

    def __init__(self, items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(items)]

    def add(self, item: int, entry: tuple) -> None:
        heap = self.heaps[item]
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)


def _read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(ids, lengths, slices, top) of a block."""
    ids = np.array([LAST_ID if i is None else i for i in row["ids"]], np.int64)
    width = -(-len(ids) // 8)
    return ids, np.array(row["lengths"], np.int64), np.frombuffer(row["slices"], np.uint8).reshape(-1, width), row["top"]


def _rows(batches):
    """The blocks one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "texts"}, batch, i


def _largest_bounds(items: tuple, k: int):
    """(item, score, block, at): the k largest bounds per item of a task."""

    def run(batches):
        mine = Items(*items)
        best = _Best(len(mine.rows), k)
        for row, _, _ in _rows(batches):
            ids, lengths, slices, top = _read(row)
            bounds = mine.bounds(slices, lengths, top)
            cut = min(k, len(ids))
            for i, at in enumerate(np.argpartition(-bounds, cut - 1, axis=1)[:, :cut].tolist()):
                for a in at:
                    if bounds[i, a] > 0:
                        best.add(i, (int(bounds[i, a]), row["block"], a))
        out = [(i, *e) for i, heap in enumerate(best.heaps) for e in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)],
                                         names=["item", "score", "block", "at"])

    return run


def _scored(items: tuple):
    """(item, score, id) of single documents for the items named with them."""

    def run(batches):
        mine = Items(*items)
        for batch in batches:
            out = []
            for key, text, which in zip(batch.column("id").to_pylist(), binary_values(batch.column("text")),
                                        batch.column("items").to_pylist()):
                out += [(i, int(s), key) for i, s in zip(which, mine.scores(text, np.array(which)))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)],
                                             names=["item", "score", "id"])

    return run


def _rescored(items: tuple, bars: tuple[list[int], list[int]], k: int):
    """(row, id, score): the k best per item of a task, of all documents whose bound is
    not provably below the item's bar."""

    def run(batches):
        mine = Items(*items)
        bar, bar_id = (np.array(b, np.int64)[:, None] for b in bars)
        best = _Best(len(mine.rows), k)
        for row, batch, i in _rows(batches):
            ids, lengths, slices, top = _read(row)
            bounds = mine.bounds(slices, lengths, top)
            open_ = (bounds > bar) | ((bounds == bar) & (bounds > 0) & (ids <= bar_id))
            texts = batch.column("texts")[i].values
            for at in np.flatnonzero(open_.any(axis=0)).tolist():
                which = np.flatnonzero(open_[:, at])
                for item, score in zip(which.tolist(), mine.scores(texts[at].as_buffer().to_pybytes(), which).tolist()):
                    if score > 0:
                        best.add(item, (score, -int(ids[at]), row["ids"][at] is None))
        out = [(int(mine.rows[i]), None if null else -key, score) for i, heap in enumerate(best.heaps)
               for score, key, null in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)],
                                         names=["row", "id", "score"])

    return run


def _item_blocks(weighed: DataFrame):
    """Lists of (row, terms, weights) whose items times distinct terms are bounded."""
    rows, terms = [], set()
    for r in weighed.toLocalIterator():
        own = [t.encode() for t in r["terms"]]
        if rows and (len(rows) + 1) * len(terms.union(own)) > ITEM_CELLS:
            yield rows
            rows, terms = [], set()
        rows.append((r["row"], own, r["weights"]))
        terms.update(own)
    if rows:
        yield rows


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, id, score): the k best documents of each item, scores above 0."""
    spark = index.sparkSession
    weighed, n, total = _weighed(index, items, id_col, text_col)
    by_item = Window.partitionBy("item").orderBy(F.desc("score"))
    out = spark.createDataFrame([], "row bigint, id bigint, score bigint")
    for rows in _item_blocks(weighed):
        block = (rows, n, total)
        first = (index.select("block", "ids", "lengths", "top", "slices")
                 .mapInArrow(_largest_bounds(block, k), "item bigint, score bigint, block bigint, at bigint")
                 .withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
                 .groupBy("block", "at").agg(F.collect_list("item").alias("items")))
        first = written(first, "search-first")  # at most k rows per item of a bounded block
        texts = (index.join(F.broadcast(first), "block")
                 .select(F.expr("ids[at]").alias("id"), F.expr("texts[at]").alias("text"), "items"))
        tried = (texts.mapInArrow(_scored(block), "item bigint, score bigint, id bigint").where("score > 0")
                 .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))))
                 .where(F.col("rank") == k).select("item", "score", "id"))
        bars = [0] * len(rows), [int(LAST_ID)] * len(rows)
        for r in tried.collect():  # one row per item
            bars[0][r["item"]], bars[1][r["item"]] = r["score"], int(LAST_ID) if r["id"] is None else r["id"]
        found = (index.select("block", "ids", "lengths", "top", "slices", "texts")
                 .mapInArrow(_rescored(block, bars, k), "row bigint, id bigint, score bigint"))
        out = out.unionByName(written(found, "search-found"))
    ranked = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (out.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .join(weighed.select("row", "item_id"), "row")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score"))


def ranked_search(df: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each item: ``search`` over a new index of ``df``."""
    return search(build_index(df), items, k)
