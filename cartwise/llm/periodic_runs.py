"""Periodic run detection: block convolution with an exact integer NTT.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends and that is at least ``max(6, 4 * q)`` words long. At each dyadic scale s the
words are cut into blocks of s words. For a block at b, the sums of squared differences
against the following window at the distances s to 2s - 1 are
``sum B^2 + sum W^2 - 2 sum B W``; the last is a cyclic convolution of 2s points by a
number-theoretic transform. A sum of zero is an occurrence without mismatch, and its
distance seeds an extension to both sides that compares words. A run of period q in
[s, 2s) holds an aligned block and its copy q words on, since it has 4q words, so every
run is found at the scale of its own period. Sums are taken modulo a prime: a true zero
is zero there too, and another one ends in the extension, which is exact.

Two tests keep blocks from the transform that cannot give anything new:

* every word of a block must come again within 2s words (an occurrence at a distance
  below 2s repeats each of its words);
* a block whose whole window lies in a run found at a lower scale (period p < s) only has
  distances that are multiples of p (the block would else equal its own rotation), and
  those have the same stretch as the run. Seeds inside such a run go for the same reason.

Two stretches with the same ends have periods that divide each other (each is four times
its period long), and the smaller is found first, so it stays.

Map-only: a task takes its rows in slices of about 1 MB of text; no row leaves its task
and copies cost what their words cost. A text is processed whole; its word numbers, next
places and masks take some 60 bytes a word, its words are split part by part.

Defined results: null and empty texts have no words and no runs; a run of one repeated
word has period 1; repeated rows each get their runs; runs are listed by start, then
period (no two agree in both); an empty table gives no rows; the result has the id and
its own columns only, so other columns cannot clash, and null ids stay.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import binary_values, slices, word_lists

LEAST_WORDS = 6
LEAST_PERIODS = 4

#: A prime with transforms of up to 2^27 points, and a generator of its units.
PRIME, GENERATOR = 15 * 2 ** 27 + 1, 31
#: Points transformed at a time, and words compared at a time.
POINTS = 1 << 16
COMPARED = 1 << 20


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo the prime, in place."""
    return np.remainder(x, np.uint64(PRIME), out=x)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, _mod(out * np.uint64(pow(base, len(out), PRIME)))])
    return out[:n]


class Transform:
    """Number-theoretic transform of rows of ``n`` points (a power of two)."""

    def __init__(self, n: int):
        self.n = n
        root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        self.down, self.up = [], []
        half = n // 2
        while half:
            step = n // (2 * half)
            self.down.append((half, _powers(pow(root, step, PRIME), half)))
            self.up.append((half, _powers(pow(pow(root, PRIME - 2, PRIME), step, PRIME), half)))
            half //= 2
        self.up.reverse()
        self.scale = np.uint64(pow(n, PRIME - 2, PRIME))

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Values in bit-reversed order, which products do not mind and ``inverse`` takes."""
        p = np.uint64(PRIME)
        for half, w in self.down:
            a = rows.reshape(len(rows), -1, 2, half)
            u, v = a[:, :, 0], a[:, :, 1]
            total = u + v
            diff = u + (p - v)
            a[:, :, 0] = np.minimum(total, total - p)  # below the prime the difference wraps to a large number
            a[:, :, 1] = _mod(diff * w) if half > 1 else np.minimum(diff, diff - p)
        return rows

    def inverse(self, rows: np.ndarray) -> np.ndarray:
        p = np.uint64(PRIME)
        for half, w in self.up:
            a = rows.reshape(len(rows), -1, 2, half)
            u = a[:, :, 0].copy()
            v = _mod(a[:, :, 1] * w) if half > 1 else a[:, :, 1].copy()
            total = u + v
            diff = u + (p - v)
            a[:, :, 0] = np.minimum(total, total - p)
            a[:, :, 1] = np.minimum(diff, diff - p)
        return _mod(rows * self.scale)


def squared_differences(blocks: np.ndarray, windows: np.ndarray, ntt: Transform) -> np.ndarray:
    """Per row, modulo the prime: sum of (block[j] - window[e + j])^2 for e = 0 .. s - 1.
    Blocks have s words, windows 2s - 1."""
    m, s = blocks.shape
    back = np.zeros((m, 2 * s), np.uint64)
    back[:, 0] = blocks[:, 0]
    back[:, s + 1:] = blocks[:, :0:-1]
    front = np.zeros((m, 2 * s), np.uint64)
    front[:, :-1] = windows
    cross = ntt.inverse(_mod(ntt.forward(back) * ntt.forward(front)))[:, :s]
    squares = np.zeros((m, 2 * s), np.uint64)
    np.cumsum(_mod(windows * windows), axis=1, out=squares[:, 1:])
    near = squares[:, s:] - squares[:, :s]
    own = _mod(blocks * blocks).sum(axis=1, keepdims=True)
    return _mod(own + near + np.uint64(2) * (np.uint64(PRIME) - cross))


def _agree(t: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, walking by ``step`` (1 or -1). Chunks
    double while all of them agree; a separator ends every walk within the array."""
    out = np.zeros(len(a), np.int64)
    live, chunk = np.arange(len(a)), 16
    while len(live):
        again = []
        rows = max(1, COMPARED // chunk)
        ahead = np.arange(chunk, dtype=np.int64) * step
        for i in range(0, len(live), rows):
            part = live[i:i + rows]
            at = out[part] * step
            x = np.clip((a[part] + at)[:, None] + ahead, 0, len(t) - 1)
            y = np.clip((b[part] + at)[:, None] + ahead, 0, len(t) - 1)
            differ = t[x] != t[y]
            n = np.where(differ.any(axis=1), differ.argmax(axis=1), chunk)
            out[part] += n
            again.append(part[n == chunk])
        live, chunk = np.concatenate(again), min(2 * chunk, COMPARED)
    return out


def _seeds(t: np.ndarray, at: np.ndarray, s: int, ntt: Transform) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every zero sum of the blocks that begin at ``at``."""
    found_at, found_d = [], []
    rows = max(1, POINTS // (2 * s))
    own, after = np.arange(s), np.arange(s, 3 * s - 1)
    for i in range(0, len(at), rows):
        b = at[i:i + rows]
        sums = squared_differences(t[b[:, None] + own].astype(np.uint64),
                                   t[np.minimum(b[:, None] + after, len(t) - 1)].astype(np.uint64), ntt)
        r, e = np.nonzero(sums == 0)
        found_at.append(b[r])
        found_d.append(e + s)
    return np.concatenate(found_at), np.concatenate(found_d)


def find_runs(t: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of the runs of ``t``: word
    numbers (below the prime) with a number that occurs once (a separator) at the front,
    at the end and between texts. ``longest``: words of the longest text."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    gap = np.full(n, np.iinfo(np.int32).max, np.int32)
    same = t[order[1:]] == t[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    reach = np.zeros(n, np.int64)  # furthest end of a found run that begins here or before
    runs, seen, s = [], set(), 1
    while LEAST_PERIODS * s <= max(longest, LEAST_WORDS):
        at = np.flatnonzero((gap[:n // s * s] < 2 * s).reshape(-1, s).all(axis=1)) * s
        at = at[reach[at] < at + 3 * s - 1]
        if len(at):
            b, d = _seeds(t, at, s, Transform(2 * s))
            new = reach[b] < b + d + s
            b, d = b[new], d[new]
            by = np.lexsort((b, d))
            b, d = b[by], d[by]
            first = np.ones(len(b), bool)  # the next block at the same distance is the same stretch
            first[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1] + s)
            b, d = b[first], d[first]
            start = b - _agree(t, b - 1, b + d - 1, -1)
            end = b + _agree(t, b, b + d, 1) + d
            good = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
            for x, y, q in zip(start[good].tolist(), end[good].tolist(), d[good].tolist()):
                if (x, y) not in seen:
                    seen.add((x, y))
                    runs.append((x, y - x, q))
                    reach[x] = max(reach[x], y)
            np.maximum.accumulate(reach, out=reach)
        s *= 2
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def numbered(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers with separators, place of the first word of each text); one more
    place ends the last text."""
    vocab: defaultdict = defaultdict()
    vocab.default_factory = vocab.__len__
    parts, sizes = [], []
    for text in texts:
        mine = [np.fromiter(map(vocab.__getitem__, words), np.int64, len(words)) for words in word_lists(text)]
        parts.append(np.concatenate(mine) if mine else np.empty(0, np.int64))
        sizes.append(len(parts[-1]))
    starts = np.concatenate([[1], 1 + np.cumsum(np.array(sizes, np.int64) + 1)])
    t = np.empty(starts[-1], np.int64)
    marks = starts - 1
    t[marks] = len(vocab) + np.arange(len(marks))
    for at, part in zip(starts.tolist(), parts):
        t[at:at + len(part)] = part
    return t, starts


def _joined(text: bytes | None, keep: np.ndarray | None) -> bytes:
    """The words of ``text`` that ``keep`` marks (None: all), joined by one space."""
    out, at = [], 0
    for words in word_lists(text):
        out += words if keep is None else compress(words, keep[at:at + len(words)].tolist())
        at += len(words)
    return b" ".join(out)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _runs_of_slice(ids, texts: list[bytes | None]) -> pa.RecordBatch:
    t, starts = numbered(texts)
    sizes = np.diff(starts) - 1
    runs = find_runs(t, int(sizes.max()))
    change = np.zeros(len(t) + 1, np.int32)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    ends = np.searchsorted(runs[:, 0], starts)
    collapsed = [_joined(text, kept[s:s + n] if e > b else None)
                 for text, s, n, b, e in zip(texts, starts.tolist(), sizes.tolist(), ends.tolist(), ends[1:].tolist())]
    local = runs[:, 0] - np.repeat(starts[:-1], np.diff(ends))
    lists = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.StructArray.from_arrays(
        [pa.array(local), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUN)))
    text = pa.array(collapsed, pa.binary()).view(pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), lists, text],
                                      names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_words, runs (array of start, length, period by start, then
    period; words numbered from 0) and collapsed: the words that lie in no run after its
    first period, joined by one space."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, "
              "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")

    def work(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _runs_of_slice(part.column("id"), list(binary_values(part.column("text"))))

    return rows.mapInArrow(work, schema)
