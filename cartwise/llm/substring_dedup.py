"""Exact substring dedup with difference-cover anchors.

A window of ``WINDOW`` (13) words is removed where its word sequence also starts
in a document with a smaller id. Anchors are runs of 7 words that start at cover
positions only: positions whose remainder modulo 7 is 0, 1 or 3. For any two
positions some shift below 7 moves both onto cover positions, so two equal windows
share an aligned anchor at one of their first seven words, and 13 = 7 + 6 words
hold it whole. Three sevenths of the positions are hashed and exchanged; only the
windows that hold an anchor seen in another document are extended to their full
13 words and exchanged by a 96-bit hash (plus the bits that choose the bucket).

Exchange. Documents are dealt into blocks by the hash of their id (a block is
about ``BLOCK_BYTES`` of text, so their number follows the input). A block sends
each bucket the distinct hashes it holds, packed into one binary value; a bucket
answers each block with the hashes other blocks hold too. However many documents
share a passage, a block sends it once, so no key gathers rows; and a hash in one
block only costs four bytes. The three passes over the texts read one shuffle of
the documents by block (the same exchange in the plan, which Spark reuses).

Defined results: null texts have no words; texts shorter than a window lose
nothing; rows with the same id are one document for the rule (a window does not
remove itself) and each keeps its own result row; a null id counts as larger than
every id; repeats inside one document only are kept; equal windows of equal ids are not
earlier than each other; a very long text is one row of its block, whose words are held
while it is joined; an empty table gives no rows; the result has its own columns only, so
others cannot clash. Rows are dealt to blocks by id and text, so null or repeated ids are
spread as well.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import binary_values, mixed, shuffle_partitions, text_bytes, word_lists

WINDOW = 13
PERIOD = 7
#: Fixed value: a difference cover modulo 7 (every remainder is a difference of two of them).
COVER = (0, 1, 3)
BLOCK_BYTES = 4 << 20
_TOP = np.iinfo(np.int64).max


def _weights(lane: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit weights of a lane."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1000 * lane)) | np.uint64(1)


class Block:
    """The word hashes of a block's documents as flat arrays."""

    def __init__(self, table: pa.Table):
        self.ids = np.array([_TOP if i is None else i for i in table.column("id").to_pylist()], np.int64)
        hashes, sizes = [], []
        digest = xxhash.xxh3_64_intdigest
        for text in binary_values(table.column("t")):
            n = 0
            for words in word_lists(text):
                hashes.append(np.array([digest(w) for w in words], np.uint64))
                n += len(words)
            sizes.append(n)
        self.words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.array(sizes, np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.offset = np.arange(len(self.words)) - np.repeat(starts, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.offset  # words from here to the document's end

    def run_hash(self, at: np.ndarray, n: int, lane: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for k, w in enumerate(_weights(lane, n)):
            h += mixed(self.words[at + k]) * w
        return mixed(h)

    def windows(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.left >= n)


def _buckets(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _sent(block: int, bucket: np.ndarray, arrays: list[np.ndarray], schema: pa.Schema) -> pa.Table:
    """A row per bucket: the entries of each array that belong to it, packed."""
    order = np.argsort(bucket, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]]) if len(order) else np.zeros(1, int)
    packed = [[a[order[s:e]].tobytes() for s, e in zip(edges, edges[1:])] for a in arrays]
    return pa.Table.from_arrays([pa.array(bucket[order[edges[:-1]]], pa.int64()),
                                 pa.array([block] * (len(edges) - 1), pa.int64()),
                                 *(pa.array(p, pa.binary()) for p in packed)], schema=schema)


def _opened(table: pa.Table, column: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a packed column and the row each came from."""
    parts = [np.frombuffer(v or b"", kind) for v in table.column(column).to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), rows


_ANCHORS = "bucket bigint, block bigint, h binary"
_WINDOWS = "bucket bigint, block bigint, a binary, b binary, first binary"


def _pa_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _functions(window: int, n_buckets: int):
    anchor = window - PERIOD + 1
    anchors_out, windows_out = _pa_schema(_ANCHORS), _pa_schema(_WINDOWS)
    answers_out = _pa_schema(_WINDOWS)

    def anchors_of(blk: Block):
        at = blk.windows(anchor)
        at = at[np.isin(blk.offset[at] % PERIOD, COVER)]
        return at, blk.run_hash(at, anchor, 1)

    def send_anchors(key, table):
        _, h = anchors_of(Block(table))
        h = np.unique(h)
        return _sent(key[0].as_py(), _buckets(h, n_buckets), [h.astype(np.uint32)], anchors_out)

    def answer_anchors(key, table):
        """Per block, the anchors that some other block holds as well."""
        h, row = _opened(table, "h", "<u4")
        order = np.argsort(h, kind="stable")
        same = np.zeros(len(h), bool)
        eq = h[order][1:] == h[order][:-1]
        same[1:] |= eq
        same[:-1] |= eq
        order = order[same]
        blocks = np.array(table.column("block").to_pylist(), np.int64)
        out = [h[np.sort(order[row[order] == r])].tobytes() for r in range(len(blocks))] if len(blocks) < 8 else \
            _by_row(h, row, order, len(blocks))
        keep = [i for i, v in enumerate(out) if v]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(keep), pa.int64()),
                                     pa.array(blocks[keep], pa.int64()),
                                     pa.array([out[i] for i in keep], pa.binary())], schema=anchors_out)

    def send_windows(key, docs, answers):
        """Every window that holds an anchor of another document, with the smallest id
        in this block."""
        if docs.num_rows == 0:
            return windows_out.empty_table()
        blk = Block(docs)
        at, h = anchors_of(blk)
        b = _buckets(h, n_buckets)
        shared = np.zeros(len(at), bool)
        low, row = _opened(answers, "h", "<u4")
        if len(low):
            theirs = np.array(answers.column("bucket").to_pylist(), np.uint64)[row] << np.uint64(32) | low
            shared = np.isin(b.astype(np.uint64) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF)), theirs)
        # anchors that two documents of this block hold
        order = np.argsort(h, kind="stable")
        ids = blk.ids[blk.doc[at[order]]]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0])) if len(h) else np.zeros(0, int)
        if len(heads):
            several = np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)
            shared[order] |= np.repeat(several, np.diff(np.append(heads, len(order))))
        # windows whose first seven words hold a shared anchor's start
        mark = np.zeros(len(blk.words) + 1, np.int32)
        p = at[shared]
        np.add.at(mark, p - np.minimum(PERIOD - 1, blk.offset[p]), 1)
        np.add.at(mark, p + 1, -1)
        starts = np.flatnonzero((np.cumsum(mark)[:-1] > 0) & (blk.left >= window))
        a, c, first = _first_in_block(blk, starts, window)
        return _sent(key[0].as_py(), _buckets(c, n_buckets), [a, c.astype(np.uint32), _narrow(first)], windows_out)

    def answer_windows(key, table):
        """Per block, the windows that start in a smaller document of another block."""
        a, row = _opened(table, "a", "<u8")
        c, _ = _opened(table, "b", "<u4")
        first = _widened(table, "first", "a")
        order = np.lexsort((c, a))
        sa, sc = a[order], c[order]
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(sa) != 0) | (np.diff(sc) != 0)])) if len(a) else np.zeros(0, int)
        least = np.empty(len(a), np.int64)
        if len(heads):
            least[order] = np.repeat(np.minimum.reduceat(first[order], heads), np.diff(np.append(heads, len(order))))
        told = np.flatnonzero(least < first) if len(a) else np.zeros(0, int)
        blocks = np.array(table.column("block").to_pylist(), np.int64)
        edges = np.searchsorted(row[told], np.arange(len(blocks) + 1))
        rows = [(i, told[s:e]) for i, (s, e) in enumerate(zip(edges, edges[1:])) if e > s]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(rows), pa.int64()),
                                     pa.array([blocks[i] for i, _ in rows], pa.int64()),
                                     pa.array([a[x].tobytes() for _, x in rows], pa.binary()),
                                     pa.array([c[x].tobytes() for _, x in rows], pa.binary()),
                                     pa.array([_narrow(least[x]).tobytes() for _, x in rows], pa.binary())],
                                    schema=answers_out)

    def finish(key, docs, answers):
        out = _pa_schema("id bigint, n_words bigint, n_removed bigint, kept_text string")
        if docs.num_rows == 0:
            return out.empty_table()
        blk = Block(docs)
        starts = blk.windows(window)
        a, c = blk.run_hash(starts, window, 2), blk.run_hash(starts, window, 3)
        ids = blk.ids[blk.doc[starts]]
        order = np.lexsort((ids, c, a))
        sa, sc = a[order], c[order]
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(sa) != 0) | (np.diff(sc) != 0)])) if len(a) else np.zeros(0, int)
        covered = np.zeros(len(blk.words) + 1, np.int32)
        if len(heads):
            least = ids[order[heads]]
            if answers.num_rows:
                ra, row = _opened(answers, "a", "<u8")
                rc, _ = _opened(answers, "b", "<u4")
                rfirst = _widened(answers, "first", "a")
                rb = np.array(answers.column("bucket").to_pylist(), np.int64)[row]
                by = np.lexsort((rc, rb, ra))
                ra, rc, rb, rfirst = ra[by], rc[by], rb[by], rfirst[by]
                ha, hc = sa[heads], sc[heads]
                hb, hl = _buckets(hc, n_buckets), (hc & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                lo = np.searchsorted(ra, ha)
                for k in range(int((np.searchsorted(ra, ha, "right") - lo).max(initial=0))):
                    i = np.minimum(lo + k, len(ra) - 1)
                    hit = (ra[i] == ha) & (rb[i] == hb) & (rc[i] == hl)
                    least = np.where(hit, np.minimum(least, rfirst[i]), least)
            first = np.empty(len(a), np.int64)
            first[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
            gone = starts[first < ids]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + window, -1)
        removed = np.cumsum(covered)[:-1] > 0
        kept, counts, at = [], [], 0
        for text in binary_values(docs.column("t")):
            words = [w for part in word_lists(text) for w in part]
            gone = removed[at:at + len(words)]
            at += len(words)
            counts.append(int(gone.sum()))
            kept.append(b" ".join(compress(words, (~gone).tolist()) if counts[-1] else words).decode("utf-8"))
        return pa.Table.from_arrays([docs.column("id").combine_chunks().cast(pa.int64()), pa.array(blk.sizes, pa.int64()),
                                     pa.array(counts, pa.int64()), pa.array(kept, pa.string())], schema=out)

    return send_anchors, answer_anchors, send_windows, answer_windows, finish


def _by_row(h, row, chosen, n):
    chosen = chosen[np.argsort(row[chosen], kind="stable")]
    edges = np.searchsorted(row[chosen], np.arange(n + 1))
    return [h[chosen[s:e]].tobytes() for s, e in zip(edges, edges[1:])]


def _first_in_block(blk: Block, starts: np.ndarray, window: int):
    """The distinct windows (two hash lanes) and the smallest id that holds each."""
    a, c, ids = blk.run_hash(starts, window, 2), blk.run_hash(starts, window, 3), blk.ids[blk.doc[starts]]
    order = np.lexsort((ids, c, a))
    a, c, ids = a[order], c[order], ids[order]
    if len(a):
        head = np.concatenate([[True], (np.diff(a) != 0) | (np.diff(c) != 0)])
        a, c, ids = a[head], c[head], ids[head]
    return a, c, ids


def _narrow(ids: np.ndarray) -> np.ndarray:
    """Ids in four bytes where they all fit."""
    return ids.astype("<u4") if len(ids) and ids.min() >= 0 and ids.max() < 1 << 32 else ids.astype("<i8")


def _widened(table: pa.Table, column: str, beside: str) -> np.ndarray:
    """Ids of a packed column; their width follows from the entries of ``beside`` (eight bytes each)."""
    parts = [np.frombuffer(v, "<u4" if 2 * len(v) == len(w) else "<i8").astype(np.int64)
             for v, w in zip(table.column(column).to_pylist(), table.column(beside).to_pylist())]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_removed, kept_text) per row of ``df``."""
    if window < PERIOD:
        raise ValueError("a window needs at least as many words as the cover's period")
    spark = df.sparkSession
    blocks = max(-(-text_bytes(df, text_col) // block_bytes), shuffle_partitions(spark))
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")) \
        .withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(blocks)))
    send_anchors, answer_anchors, send_windows, answer_windows, finish = _functions(window, blocks)
    result = "id bigint, n_words bigint, n_removed bigint, kept_text string"
    shared = (docs.groupBy("block").applyInArrow(send_anchors, _ANCHORS)
              .groupBy("bucket").applyInArrow(answer_anchors, _ANCHORS))
    earlier = (docs.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(send_windows, _WINDOWS)
               .groupBy("bucket").applyInArrow(answer_windows, _WINDOWS))
    return docs.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(finish, result)
