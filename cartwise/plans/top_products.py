"""Exact top lists by inner product without the roles x items grid (M7, Q13).

Items are put in order of their vector's length and read in blocks that double in size up
to ``MOST_ITEMS``. A role is compared with one block after the other and keeps its k best;
it is done once its k-th best score is above what any later item can reach (the role's
length times the next item's, by Cauchy and Schwarz). Done roles leave the table, so a
pass reads only the roles still open and sends one block of bounded size to the tasks.
Scores are the same sums as ``factorize.dot`` makes, so the lists are the grid's first k.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.ranking import range_positions
from cartwise.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Items of the first block and of the largest.
FIRST_ITEMS, MOST_ITEMS = 64, 1 << 15
#: Roles compared with a block at a time in a task.
ROLE_ROWS = 256
#: The bound is drawn up by this part, above what rounding of a sum can hide.
SLACK = 1e-5


def _vectors(column, rank: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), rank)


def _scores(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Products in the vectors' own type, added up in doubles in order."""
    out = np.zeros((len(u), len(v)))
    for i in range(u.shape[1]):
        out += (u[:, i:i + 1] * v[:, i]).astype(np.float64)
    return out


def _pass(items: np.ndarray, vectors: np.ndarray, next_length: float, k: int, rank: int):
    """Open roles against one block: the state with the k best so far, and whether the role is done."""
    id_type = pa.int64()

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROLE_ROWS):
                b = whole.slice(at, ROLE_ROWS)
                u = _vectors(b.column("features"), rank)
                scores = _scores(u, vectors)
                old_items, old_scores = b.column("items").to_pylist(), b.column("scores").to_pylist()
                bound = np.sqrt((u.astype(np.float64) ** 2).sum(axis=1)) * next_length * (1 + SLACK)
                best_items, best_scores, done = [], [], []
                for i in range(len(u)):
                    s = np.concatenate([old_scores[i], scores[i]])
                    ids = np.concatenate([np.array(old_items[i], np.int64), items])
                    if len(s) > k:
                        floor = np.partition(s, len(s) - k)[len(s) - k]
                        near = np.flatnonzero(s >= floor)
                        s, ids = s[near], ids[near]
                    order = np.lexsort((ids, -s))[:k]
                    best_items.append(ids[order])
                    best_scores.append(s[order])
                    done.append(next_length < 0 or (len(order) == k and s[order[-1]] > bound[i]))
                yield pa.RecordBatch.from_arrays(
                    [b.column("role_id"), b.column("features"), pa.array(best_items, pa.list_(id_type)),
                     pa.array(best_scores, pa.list_(pa.float64())), pa.array(done)],
                    names=["role_id", "features", "items", "scores", "done"])

    return run


def top_products(roles: DataFrame, items: DataFrame, k: int = 25) -> tuple[DataFrame, int]:
    """((role_id, item_id, score, position) of the k best items of every role, and the
    pairs that were scored). ``roles`` and ``items`` hold ids and ``features``; ties go to
    the smaller item. No items or no roles: no rows."""
    spark = roles.sparkSession
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    placed = materialize(range_positions(items.select("item_id", "features", length.alias("length")),
                                         [F.col("length").desc(), F.col("item_id").asc()], "place"))
    n = placed.count()
    state = materialize(roles.select("role_id", "features", F.array().cast("array<bigint>").alias("items"),
                                     F.array().cast("array<double>").alias("scores"), F.lit(False).alias("done")))
    open_ = state.count()
    schema = (f"role_id {state.schema['role_id'].dataType.simpleString()}, features array<float>, items array<bigint>, "
              "scores array<double>, done boolean")
    out, at, size, scored = state.limit(0), 0, FIRST_ITEMS, 0
    while at < n and open_:
        block = placed.where(F.col("place").between(at, at + size)).orderBy("place").collect()  # one block and the next item
        here, after = block[:size], block[size:]
        vectors = np.array([r["features"] for r in here], np.float32)
        passed = materialize(state.mapInArrow(
            _pass(np.array([r["item_id"] for r in here], np.int64), vectors, after[0]["length"] if after else -1.0, k,
                  vectors.shape[1]), schema))
        scored += open_ * len(here)
        out, state = out.unionByName(passed.where("done")), passed.where("NOT done")
        open_, at, size = state.count(), at + len(here), min(2 * size, MOST_ITEMS)
    lists = out.select("role_id", F.posexplode(F.arrays_zip("items", "scores")).alias("position", "x"))
    return lists.select("role_id", F.col("x.items").alias("item_id"), F.col("x.scores").alias("score"),
                        F.col("position").cast("bigint").alias("position")), scored


def recommend_top(test_roles: DataFrame, f, catalog: DataFrame, k: int = 25, catalog_blacklist=()) -> tuple[DataFrame, int]:
    """The first k of ``factorize.recommend_fallback`` per test role, with its ``source``,
    and the pairs scored. Roles without a vector share the popularity list's first k."""
    from cartwise.operators.joins import bucketed_grid
    from cartwise.operators.metrics import popularity
    mf_catalog = catalog.where(~F.col("item_id").isin(list(catalog_blacklist))).select("item_id") if catalog_blacklist \
        else catalog.select("item_id")
    roles = test_roles.select("role_id").distinct()
    known, scored = top_products(f.roles.join(roles, "role_id", "left_semi"), f.items.join(mf_catalog, "item_id", "left_semi"), k)
    first = popularity(f.train, mf_catalog).where(F.col("position") < k)
    unknown = roles.join(f.roles.select("role_id"), "role_id", "left_anti")
    popular = bucketed_grid(unknown, first, n_items=k).select(
        "role_id", "item_id", F.col("n").cast("double").alias("score"), "position", F.lit("popular").alias("source"))
    return known.withColumn("source", F.lit("mf")).unionByName(popular), scored
