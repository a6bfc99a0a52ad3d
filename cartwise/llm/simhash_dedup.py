"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments (one fewer than the three a plain
pigeonhole index of distance 2 needs). Of two fingerprints that differ in at
most two bits, some segment differs in at most one, so masking one bit of a
segment (the "deleted" bit, 32 choices per segment) gives an equal key. The keys
meet in an equality shuffle, and members of a key are verified by their exact
bit distance. Only distinct fingerprints are indexed, so exact copies and equal
prints cost one row however many documents share them.

A key with more than ``GROUP_CAP`` fingerprints is not compared pairwise: its
fingerprints go to a second equality index in which two of all 64 bits are
masked (2,016 keys each, at most four fingerprints to a key). Fingerprints that
share such a key differ in at most two bits, and every such pair shares one, so
no link is lost and the work stays linear.

Defined results: null or empty texts and texts without words have fingerprint
zero and link like any other; repeated rows stay repeated; a null id is kept and
never names a component unless no member has an id; very long texts are hashed whole;
of equally small ids the smaller text key stays; an empty table gives no rows;
``near_dedup`` keeps all columns of ``df``, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import binary_values, named_rows, record_batches, text_key, word_lists, written
from cartwise.llm.graph import components

SEED = 42
DISTANCE = 2
#: Members of one key that are compared pairwise inside a task (about 8 MB of
#: distances); larger keys take the second index.
GROUP_CAP = 1024


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``width`` words joined by one space."""
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:].tolist())], dtype=np.uint64)


def simhash(text: bytes | None, width: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; A-Z is lower-cased."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_lists((text or b"").lower()):
        words = tail + words
        if len(words) >= width:
            h = shingle_hashes(words, width)
            total += len(h)
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            tail = words[len(words) - width + 1:]
        else:
            tail = words
    if not total and tail:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], dtype=np.uint64)
        total, ones = 1, np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, key, fp): one signed 64-bit fingerprint per row; ``key`` is of its text."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def prints(batches):
        for b in batches:
            values = [simhash(t, width) for t in binary_values(b.column("t"))]
            yield pa.record_batch([b.column("id").cast(pa.int64()), b.column("key"), pa.array(values, pa.int64())],
                                  schema=schema)

    return df.select(F.col(id_col).cast("bigint").alias("id"), text_key(text_col).alias("key"),
                     F.col(text_col).alias("t")).mapInArrow(prints, "id bigint, key bigint, fp bigint")


def _variants(batches):
    """64 keys a fingerprint: (segment, masked bit, the segment without that bit)."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    slot = np.arange(64, dtype=np.uint64)
    masks = ~(np.uint64(1) << (slot % np.uint64(32))) & np.uint64(0xFFFFFFFF)
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fp), 1 << 14):
            part = fp[at:at + (1 << 14), None]
            segment = np.where(slot < 32, part & np.uint64(0xFFFFFFFF), part >> np.uint64(32))
            key = (slot << np.uint64(32)) | (segment & masks)
            yield from record_batches(schema, [key.reshape(-1).view(np.int64),
                                               np.broadcast_to(part, key.shape).reshape(-1).view(np.int64)], 1 << 18)


def _linked(fps: np.ndarray, distance: int) -> np.ndarray:
    """For each member, the index of the first member it reaches inside the group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    root = np.arange(len(fps))
    while True:
        new = np.where(near, root[None, :], len(fps)).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(distance: int, cap: int):
    """Over rows sorted by key: edges to the root of each verified subgroup (kind 0),
    and the members of keys with more than ``cap`` fingerprints (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def scan(batches):
        open_key, held, heavy = None, [], False

        def out(kind, a, b):
            return record_batches(schema, [np.full(len(a), kind, np.int32), a.view(np.int64), b.view(np.int64)])

        def group(fps):
            if len(fps) > 1:
                root = _linked(fps, distance)
                moved = root != np.arange(len(fps))
                if moved.any():
                    yield from out(0, fps[moved], fps[root[moved]])

        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            first = 0
            if open_key is not None and key[0] == open_key:  # the open key goes on
                held.append(fp[:cuts[1]])
                first = 1
            if len(cuts) - 1 > first:  # the open key is complete
                if heavy:
                    for h in held:
                        yield from out(1, h, h)
                elif held:
                    yield from group(np.concatenate(held))
                held, heavy = [], False
                sizes = np.diff(cuts)
                inner = np.arange(first, len(cuts) - 2)
                two = inner[sizes[inner] == 2]
                a, b = fp[cuts[two]], fp[cuts[two] + 1]
                close = np.bitwise_count(a ^ b) <= distance
                if close.any():
                    yield from out(0, a[close], b[close])
                for g in inner[sizes[inner] > 2]:
                    members = fp[cuts[g]:cuts[g + 1]]
                    if len(members) > cap:
                        yield from out(1, members, members)
                    else:
                        yield from group(members)
                open_key, held = key[-1], [fp[cuts[-2]:]]
            if sum(map(len, held)) > cap or heavy:
                heavy = True
                for h in held:
                    yield from out(1, h, h)
                held = []
        if held and not heavy:
            yield from group(np.concatenate(held))

    return scan


def _two_bit_variants(batches):
    schema = pa.schema([("mask", pa.int64()), ("rest", pa.int64()), ("fp", pa.int64())])
    masks = np.array([(1 << i) | (1 << j) for i, j in combinations(range(64), 2)], dtype=np.uint64)
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(fp), 128):
            part = fp[at:at + 128, None]
            rest = part & ~masks
            yield from record_batches(schema, [np.broadcast_to(x, rest.shape).reshape(-1).view(np.int64)
                                               for x in (masks, rest, part)], 1 << 18)


def links(prints: DataFrame, distance: int = DISTANCE, cap: int = GROUP_CAP) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of the
    graph that joins every two fingerprints at ``distance`` (2) or less."""
    if distance != DISTANCE:
        raise ValueError("two segments with one masked bit each serve a distance of exactly two bits")
    keyed = prints.select("fp").mapInArrow(_variants, "key bigint, fp bigint")
    found = written(keyed.repartition("key").sortWithinPartitions("key")
                    .mapInArrow(_verified(distance, cap), "kind int, a bigint, b bigint"), "simhash-links")
    heavy = found.where("kind = 1").selectExpr("a AS fp").distinct()
    second = heavy.mapInArrow(_two_bit_variants, "mask bigint, rest bigint, fp bigint")
    second = (second.groupBy("mask", "rest").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("fps"))
              .where(F.size("fps") > 1).select(F.explode("fps").alias("a"), "b").where("a <> b"))
    return found.where("kind = 0").select("a", "b").unionAll(second.select("a", "b"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       distance: int = DISTANCE, cap: int = GROUP_CAP) -> DataFrame:
    """(id, key, fp, component, component_id) per row. ``component_id`` is the smallest id
    reachable over links of at most ``distance`` differing bits (null if no member has
    an id), ``component`` the smallest fingerprint, ``key`` of the row's text."""
    rows = written(fingerprints(df, id_col, text_col, width), "simhash")
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    comp = written(components(links(prints, distance, cap)), "simhash-components")
    named = prints.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("c"))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "c").select("fp", F.col("c").alias("component"), "component_id"), "fp") \
        .select("id", "key", "fp", "component", "component_id")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
               distance: int = DISTANCE) -> DataFrame:
    """One row of each component, with the columns of ``df``: its smallest id, nulls
    last, then the smallest text key. Rows with that id and text count as one; rows
    of other components stay, also where ids are null or repeated."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    keep = (simhash_components(df, id_col, text_col, width, distance).groupBy("component").agg(first)
            .select(F.col("first.id").alias("kept_id"), F.col("first.key").alias("kept_key")))
    return (named_rows(df, id_col, text_col).join(
        keep, F.col("i").eqNullSafe(F.col("kept_id")) & (F.col("k") == F.col("kept_key")), "left_semi")
        .dropDuplicates(["i", "k"]).select("row.*"))
