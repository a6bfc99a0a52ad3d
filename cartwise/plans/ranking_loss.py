"""Ranking-loss factorisation by blocked pairwise learning (M3).

For a role and an item it interacted with, items it did not are drawn until one scores
higher than the item less a margin of 1; the two are then moved apart by a step that weighs
the item's estimated rank, log((items - 1) / draws), so early mistakes count most.

Roles and items are dealt into equally many blocks by a hash of their id. A round puts
every role block together with one item block; the pairs of blocks of a round share no
role and no item, so they are learned side by side, and after as many rounds as there are
blocks an epoch has seen every interaction. A task holds the vectors of its two blocks and
the interactions between them; blocks are as many as the counts ask for, so its size is
bounded, and one role or item adds at most a block's rows of the other side. Vectors are
written after every round.

Draws come from a generator seeded by epoch, round and block, rows are taken in id order,
and nothing is summed across tasks: a seed gives the same vectors for any partitioning.
Negatives of a round come from the item block at hand, which over an epoch is all of them.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import MF_EPOCHS, MF_RANK
from cartwise.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Roles, items and interactions aimed at per block (of interactions: per pair of blocks).
BLOCK_ROLES, BLOCK_ITEMS, BLOCK_PAIRS = 100_000, 100_000, 2_000_000
LEAST_BLOCKS = 4
#: Items drawn for an interaction before it counts as learned, and interactions moved at a time.
DRAWS, BATCH = 10, 64
#: A vector travels as [vector, bias, sums of its squared gradients].
_STATE = "task int, kind int, id bigint, other bigint, state array<double>"


def _learned(rank: int, rate: float, seed: int, items: int):
    """One pair of blocks: kind 0 roles, 1 items, 2 interactions (role, item)."""
    schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("state", pa.list_(pa.float64()))])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("id", "ascending"), ("other", "ascending")])
        kind, ids = table.column("kind").to_numpy(), table.column("id").to_numpy()
        ends = np.searchsorted(kind, [1, 2])
        vectors = table.column("state").slice(0, int(ends[1])).combine_chunks()
        state = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * rank + 2)
        x, sums = state[:, :rank + 1].copy(), state[:, rank + 1:].copy()
        role_ids, item_ids = ids[:ends[0]], ids[ends[0]:ends[1]]
        u = np.searchsorted(role_ids, ids[ends[1]:])
        v = np.searchsorted(item_ids, table.column("other").to_numpy()[ends[1]:])
        if len(u) and len(item_ids) > 1:
            known = np.sort(u * len(item_ids) + v)
            rng = np.random.default_rng([seed, int(table.column("task")[0].as_py())])
            order = rng.permutation(len(u))
            for at in range(0, len(order), BATCH):
                _move(x, sums, u[order[at:at + BATCH]], v[order[at:at + BATCH]], len(role_ids), len(item_ids), known, rng, rank,
                      rate, items)
        out = np.hstack([x, sums])
        edges = np.arange(len(out) + 1, dtype=np.int32) * (2 * rank + 2)
        return pa.Table.from_arrays([pa.array(kind[:ends[1]], pa.int32()), pa.array(ids[:ends[1]], pa.int64()),
                                     pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(out.ravel()))], schema=schema)

    return run


def _move(x, sums, u, v, n_roles, n_items, known, rng, rank, rate, items):
    """One batch: draws, then the steps of all its violations at once."""
    drawn = rng.integers(0, n_items, (len(u), DRAWS))
    key = u[:, None] * n_items + drawn
    place = np.minimum(np.searchsorted(known, key), len(known) - 1)
    other = known[place] != key
    role, good = x[u, :rank], x[n_roles + v]
    bad = x[n_roles + drawn]
    wins = (role * good[:, :rank]).sum(axis=1) + good[:, rank]
    rivals = np.einsum("br,bdr->bd", role, bad[:, :, :rank]) + bad[:, :, rank]
    violates = other & (rivals > wins[:, None] - 1)
    some = np.flatnonzero(violates.any(axis=1))
    if not len(some):
        return
    first = violates[some].argmax(axis=1)
    tried = np.cumsum(other[some], axis=1)[np.arange(len(some)), first]
    weight = np.log(np.maximum(1.0, (items - 1) // tried))[:, None]
    neg = drawn[some, first]
    a, b, c = u[some], n_roles + v[some], n_roles + neg
    one = np.ones((len(some), 1))
    steps = [(a, np.hstack([x[c, :rank] - x[b, :rank], 0 * one]) * weight), (b, -np.hstack([x[a, :rank], one]) * weight),
             (c, np.hstack([x[a, :rank], one]) * weight)]
    for at, g in steps:
        rows, which = np.unique(at, return_inverse=True)
        total = np.zeros((len(rows), rank + 1))
        np.add.at(total, which, g)
        sums[rows] += total ** 2
        x[rows] -= rate * total / np.sqrt(sums[rows])


def _first(ids: DataFrame, rank: int, seed: int, side: int, flat: int) -> DataFrame:
    """(id, state) of new vectors: small values from a hash of the id, bias 0, sums 1."""
    unit = F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda i: (
        F.pmod(F.xxhash64(F.lit(seed), F.lit(side), F.col("id"), i), F.lit(2_000_001)) / 1_000_000.0 - 1.0) / float(2 * rank))
    return ids.select("id", F.concat(unit, F.array(F.lit(0.0)), F.array_repeat(F.lit(1.0), flat)).alias("state"))


def fit_ranking(train: DataFrame, rank: int = MF_RANK, epochs: int = MF_EPOCHS, rate: float = 0.05, seed: int = 7,
                weight: str = "num"):
    """``factorize.Factors`` learned by the ranking loss from the (role, item) pairs of
    ``train`` with a positive summed ``weight``. The last of the ``rank + 1`` features is
    the item's bias (1 for roles), so a dot product is the score. No rows: no vectors."""
    from cartwise.plans.factorize import Factors
    pairs = materialize(train.groupBy("role_id", "item_id").agg(F.sum(weight).alias("_w")).where("_w > 0")
                        .select(F.col("role_id").cast("bigint").alias("id"), F.col("item_id").cast("bigint").alias("other")))
    facts = pairs.agg(F.count("*").alias("n"), F.countDistinct("id").alias("u"), F.countDistinct("other").alias("v")).first()
    blocks = max(LEAST_BLOCKS, -(-facts["u"] // BLOCK_ROLES), -(-facts["v"] // BLOCK_ITEMS),
                 int(np.ceil(np.sqrt(facts["n"] / BLOCK_PAIRS))))
    block = lambda c, salt: F.pmod(F.xxhash64(F.lit(salt), F.col(c)), F.lit(blocks)).cast("int")
    nothing = F.lit(None).cast("array<double>")
    pairs = materialize(pairs.select(block("id", 1).alias("rb"), block("other", 2).alias("ib"), "id", "other"))
    vectors = [materialize(_first(pairs.select(F.col(c).alias("id")).distinct(), rank, seed, side, rank + 1)
                           .withColumn("block", block("id", side + 1))) for side, c in enumerate(("id", "other"))]
    for epoch in range(epochs):
        for turn in range(blocks):
            # item block i meets role block i + turn
            task = lambda c: F.pmod(F.col(c) + F.lit(turn), F.lit(blocks)).cast("int")
            rows = (vectors[0].select(F.col("block").alias("task"), F.lit(0).alias("kind"), "id", F.lit(0).cast("bigint").alias("other"), "state")
                    .unionByName(vectors[1].select(task("block").alias("task"), F.lit(1).alias("kind"), "id",
                                                   F.lit(0).cast("bigint").alias("other"), "state"))
                    .unionByName(pairs.where(F.col("rb") == task("ib")).select(
                        F.col("rb").alias("task"), F.lit(2).alias("kind"), "id", "other", nothing.alias("state"))))
            moved = materialize(rows.groupBy("task").applyInArrow(
                _learned(rank, rate, seed * 1_000_003 + epoch * blocks + turn, facts["v"]), "kind int, id bigint, state array<double>"))
            vectors = [moved.where(F.col("kind") == side).select("id", "state", block("id", side + 1).alias("block"))
                       for side in (0, 1)]
    roles, items = (v.select(F.col("id").alias(c), F.expr(e).alias("features")) for v, c, e in zip(
        vectors, ("role_id", "item_id"), (f"concat(slice(state, 1, {rank}), array(1D))", f"slice(state, 1, {rank + 1})")))
    return Factors(None, roles, items, train)
