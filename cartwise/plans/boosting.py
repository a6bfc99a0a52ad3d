"""Second-order boosted trees over a binned, written feature matrix.

The fit starts from the base rate and adds trees of at most 15 leaves and depth 4 at
a step of 0.02. A tree's splits are chosen from histograms (node, feature, bin) of
gradient, curvature and row count: each task sums its own rows, Spark adds the tasks'
sums, and the driver sees only the histograms, whose size does not depend on the rows.
The nodes of a level are measured in one job, only the smaller child of each split (its
sibling is the parent less it). Four levels give every split a leaf-wise tree of depth 4
can take, and the splits are then taken best first until there are 15 leaves, which is
the leaf-wise tree.

Rows are kept as packed bins (one byte a feature) with their margin. The margin table is
written again every ``WRITE_EVERY`` rounds; between two writes a task adds the few trees
made since. Nothing is fitted twice, and a lost task reads the last table again.

Sums are whole numbers (values in units of 2^-30), so the trees do not depend on how rows
are dealt out. The bag of a row is a hash of its key and holds for 17 rounds; each tree
sees a seeded subset of the columns. The hold-out loss of every round, the constant base
rate included, is kept; the fit ends after ``patience`` rounds without a gain and keeps
the best round.

Missing values are below every cut. Without hold-out rows all ``rounds`` are fitted.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.constants import (GBT_BAG_ROUNDS, GBT_DEPTH, GBT_FEATURE_FRACTION, GBT_LEAVES, GBT_PATIENCE, GBT_ROUNDS,
                                GBT_STEP, GBT_SUBSAMPLE)
from cartwise.session import materialize

# tasks get the functions of this module by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a feature, one of them for missing values.
BINS = 64
#: Rounds between two writes of the margin table.
WRITE_EVERY = 15
#: The learner's own least rows and least curvature of a leaf.
LEAST_ROWS, LEAST_CURVATURE = 20, 1e-3
UNIT = float(1 << 30)
_NODES = 2 ** (GBT_DEPTH + 1)
_TABLE = "key bigint, label double, held boolean, x binary, margin double"


@dataclass
class Tree:
    """Nodes in heap order (1 is the root): the split feature (-1: leaf), the last bin
    that goes left, and the value of a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        node = np.ones(len(x), np.int64)
        if (self.feature < 0).all():
            return node
        # a leaf's bound is above every bin, so that its rows stay
        flat, start = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        inner, here = self.feature >= 0, np.arange(len(self.feature))
        feature, last, next_ = np.maximum(self.feature, 0), np.where(inner, self.bin, BINS), np.where(inner, 2 * here, here)
        for _ in range(GBT_DEPTH):
            node = next_.take(node) + (flat.take(start + feature.take(node)) > last.take(node))
        return node

    def leaf_count(self) -> int:
        return int((self.feature >= 0).sum()) + 1


@dataclass
class Boosted:
    """A fitted model: ``losses[i]`` is the hold-out loss with i trees."""

    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]
    losses: list[float]
    fitted: int

    @property
    def best_round(self) -> int:
        return len(self.trees)


def _bins(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Row-major bins: 0 for missing values, else 1 + the cuts below the value."""
    out = np.empty((len(columns[0]), len(columns)), np.uint8)
    for i, (c, own) in enumerate(zip(columns, cuts)):
        out[:, i] = np.where(np.isnan(c), 0, 1 + np.searchsorted(own, c, "left"))
    return out


def quantile_cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins - 2`` cuts per feature (its distributed quantiles, below its
    largest value), so that a value goes left of a cut it does not exceed."""
    if not features:
        return []
    steps = [i / (bins - 1) for i in range(bins)]
    found = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features]).approxQuantile(features, steps, 0.0005)
    return [sorted(set(q))[:-1][:bins - 2] for q in found]


def _matrix(column, width: int) -> np.ndarray:
    """The packed bins of a batch as (rows x features)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty((0, width), np.uint8)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return data[at:at + len(column) * width].reshape(-1, width)


def _doubles(batch, names) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in names]


def _binned(features: list[str], cuts: list[list[float]], base: float):
    own = [np.array(c) for c in cuts]

    def run(batches):
        for b in batches:
            x = _bins(_doubles(b, features), own) if features else np.empty((b.num_rows, 0), np.uint8)
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(
                (np.arange(len(x) + 1) * x.shape[1]).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_label"), b.column("_held"), packed,
                                              pa.array(np.full(len(x), base))], ["key", "label", "held", "x", "margin"])

    return run


def _in_bag(keys: np.ndarray, bag: int, part: float) -> np.ndarray:
    h = keys.view(np.uint64) ^ np.uint64((0x9E3779B97F4A7C15 * (bag + 1)) & (2 ** 64 - 1))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (h >> np.uint64(11)).astype(np.float64) < part * float(1 << 53)


def _margin(margin: np.ndarray, x: np.ndarray, since: list[Tree]) -> np.ndarray:
    out = margin.copy()
    for tree in since:
        out += tree.value[tree.leaves(x)]
    return out


def _histograms(width: int, since: list[Tree], tree: Tree, nodes: list[int], subset: list[int], bag: int, part: float,
                with_loss: bool):
    """Per task: (node, feature, bin, g, h, n) of the bag's rows in ``nodes``; node 0
    carries the hold-out loss and rows."""
    slot = np.full(_NODES, -1, np.int64)
    slot[nodes] = np.arange(len(nodes))
    cols, shape = np.array(subset, np.int64), (len(nodes), len(subset), BINS)

    def run(batches):
        g, h, n = (np.zeros(shape, np.int64) for _ in range(3))
        loss = rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), width)
            y, held = b.column("label").to_numpy(), b.column("held").to_numpy(zero_copy_only=False)
            start = b.column("margin").to_numpy()
            if with_loss and held.any():
                margin = _margin(start[held], x[held], since)
                loss += int(np.rint(np.logaddexp(0.0, np.where(y[held] > 0, -margin, margin)) * UNIT).astype(np.int64).sum())
                rows += int(held.sum())
            mine = np.flatnonzero(~held & _in_bag(b.column("key").to_numpy(), bag, part))
            at = slot[tree.leaves(x[mine])]
            mine, at = mine[at >= 0], at[at >= 0]
            if not len(mine) or not len(cols):
                continue
            # only rows of the nodes asked for need the trees since the last write
            x = x[mine]
            p = 1.0 / (1.0 + np.exp(-_margin(start[mine], x, since)))
            values = np.rint((p - y[mine]) * UNIT), np.rint((p * (1 - p)) * UNIT), None
            at *= BINS
            for i, f in enumerate(cols):
                place = at + x[:, f]
                for out, value in zip((g, h, n), values):
                    out[:, i] += np.bincount(place, value, len(nodes) * BINS).astype(np.int64).reshape(-1, BINS)
        g, h, n = g.ravel(), h.ravel(), n.ravel()
        some = np.flatnonzero(n)
        node, f, z = np.unravel_index(some, shape)
        out = [np.array(nodes, np.int64)[node], cols[f], z, g[some], h[some], n[some]]
        if with_loss:
            out = [np.append(c, v) for c, v in zip(out, (0, 0, 0, loss, 0, rows))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["node", "feature", "bin", "g", "h", "n"])

    return run


def _measured(table: DataFrame, *args) -> tuple[dict[int, np.ndarray], tuple[int, int]]:
    """node -> (3 x features x bins) sums, and the hold-out (loss, rows)."""
    width, subset = args[0], args[4]
    place = {f: i for i, f in enumerate(subset)}
    rows = (table.mapInArrow(_histograms(*args), "node bigint, feature bigint, bin bigint, g bigint, h bigint, n bigint")
            .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")))
    out, loss = {node: np.zeros((3, len(subset), BINS)) for node in args[3]}, (0, 0)
    for r in rows.collect():  # nodes x features x bins, whatever the number of rows
        if r["node"] == 0:
            loss = (r["g"], r["n"])
        else:
            out[r["node"]][:, place[r["feature"]], r["bin"]] = r["g"] / UNIT, r["h"] / UNIT, r["n"]
    return out, loss


def best_split(hist: np.ndarray) -> tuple[float, int, int] | None:
    """(gain, place of the feature, last bin that goes left) of the best split of a node,
    ties to the first feature and bin; None where no split gains."""
    left = hist.cumsum(axis=2)[:, :, :-1]
    total = hist.sum(axis=2)[:, :1, None]
    right = total - left
    ok = (np.minimum(left[2], right[2]) >= LEAST_ROWS) & (np.minimum(left[1], right[1]) >= LEAST_CURVATURE)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - total[0] ** 2 / total[1]
    gain = np.where(ok, gain, -np.inf)
    f, z = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, z]), int(f), int(z)) if gain[f, z] > 1e-12 else None


def _grown(measure, subset: list[int], leaves: int, step: float) -> Tree:
    """The leaf-wise tree: all splits level by level, then the best first."""
    tree = Tree(np.full(_NODES, -1, np.int64), np.zeros(_NODES, np.int64), np.zeros(_NODES))
    hists, splits, ask = {}, {}, [1]
    if not subset:
        measure(tree, ask)
        return tree
    for _ in range(GBT_DEPTH):
        if not ask:
            break
        hists.update(measure(tree, ask))
        for node in ask:
            if node > 1:
                hists[node ^ 1] = hists[node // 2] - hists[node]
        here, ask = [m for n in ask for m in ((n, n ^ 1) if n > 1 else (n,))], []
        for node in sorted(here):
            found = best_split(hists[node])
            if found:
                gain, f, z = found
                splits[node] = gain
                tree.feature[node], tree.bin[node] = subset[f], z
                rows = hists[node][2, f]
                ask.append(2 * node if rows[:z + 1].sum() <= rows[z + 1:].sum() else 2 * node + 1)
    totals = {node: h[:, 0].sum(axis=1) for node, h in hists.items()}
    for node in list(splits):  # children of the last level: sums of their side of the split
        f, z = subset.index(int(tree.feature[node])), int(tree.bin[node])
        totals[2 * node] = hists[node][:, f, :z + 1].sum(axis=1)
        totals[2 * node + 1] = totals[node] - totals[2 * node]
    taken, open_ = set(), [1] if 1 in splits else []
    while open_ and len(taken) < leaves - 1:
        node = max(open_, key=lambda n: (splits[n], -n))
        open_.remove(node)
        taken.add(node)
        open_ += [c for c in (2 * node, 2 * node + 1) if c in splits]
    for node in range(1, _NODES):
        if node not in taken:
            tree.feature[node] = -1
            if node in totals and (node == 1 or node // 2 in taken):
                g, h, _ = totals[node]
                tree.value[node] = -step * g / h if h > 0 else 0.0
    if not taken:
        tree.value[1] = 0.0
    return tree


def fit(rows: DataFrame, features: list[str], key: Column, held: Column, rounds: int = GBT_ROUNDS,
        patience: int = GBT_PATIENCE, step: float = GBT_STEP, leaves: int = GBT_LEAVES, part: float = GBT_SUBSAMPLE,
        columns: float = GBT_FEATURE_FRACTION, seed: int = 17) -> Boosted:
    """Fit ``label`` of ``rows`` (written by the caller). ``key``: a 64-bit key per row;
    ``held``: true for hold-out rows. Equal keys share their bag."""
    facts = rows.where(~held).agg(F.avg(F.col("label").cast("double")).alias("p"), F.count("*").alias("n")).first()
    rate = min(max(facts["p"] or 0.0, 1e-6), 1 - 1e-6)
    base = float(np.log(rate / (1 - rate)))
    cuts = quantile_cuts(rows.where(~held), features) if facts["n"] else [[] for _ in features]
    table = rows.select(key.alias("_key"), F.col("label").cast("double").alias("_label"), held.alias("_held"),
                        *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    table = materialize(table.mapInArrow(_binned(features, cuts, base), _TABLE))
    width, rng = len(features), np.random.default_rng(seed)
    trees: list[Tree] = []
    losses: list[float] = []
    since: list[Tree] = []
    best = 0
    while True:
        subset = sorted(rng.choice(width, max(1, round(columns * width)), replace=False).tolist()) if width else []
        bag = len(trees) // GBT_BAG_ROUNDS
        seen = []

        def measure(tree, nodes):
            out, loss = _measured(table, width, since, tree, nodes, subset, bag, part, not seen)
            if not seen:
                seen.append(loss)
            return out

        tree = _grown(measure, subset, leaves, step)  # its first job also measures the loss before this tree
        loss, held_rows = seen[0]
        losses.append(loss / UNIT / held_rows if held_rows else 0.0)
        if held_rows and losses[-1] < losses[best]:
            best = len(trees)
        if (held_rows and len(trees) - best >= patience) or len(trees) >= rounds:
            break
        trees.append(tree)
        since.append(tree)
        if len(since) == WRITE_EVERY:
            table = materialize(table.mapInArrow(_with_margin(width, since), _TABLE))
            since = []
    kept = best if held_rows else len(trees)
    return Boosted(features, cuts, base, trees[:kept], losses, len(trees))


def _with_margin(width: int, since: list[Tree]):
    def run(batches):
        for b in batches:
            margin = _margin(b.column("margin").to_numpy(), _matrix(b.column("x"), width), since)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("key", "label", "held", "x")], pa.array(margin)],
                                             ["key", "label", "held", "x", "margin"])

    return run


def score(model: Boosted, rows: DataFrame, out: str = "score") -> DataFrame:
    """``rows`` with the positive-class probability. Only the model's columns go
    through Arrow; a model without trees is a constant."""
    if not model.trees or not model.features:
        return rows.withColumn(out, F.lit(float(1 / (1 + np.exp(-model.base)))))
    features, cuts, base, trees = model.features, [np.array(c) for c in model.cuts], model.base, model.trees

    @F.arrow_udf("double")
    def probability(*columns: pa.Array) -> pa.Array:
        x = _bins([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns], cuts)
        margin = np.full(len(x), base)
        for tree in trees:
            margin += tree.value[tree.leaves(x)]
        return pa.array(1.0 / (1.0 + np.exp(-margin)))

    return rows.withColumn(out, probability(*[F.col(f"`{c}`").cast("double") for c in features]))


def save(model: Boosted, spark: SparkSession, path: str) -> str:
    """The model as a table: one row of settings and one per node."""
    head = json.dumps({"features": model.features, "cuts": model.cuts, "base": model.base, "losses": model.losses,
                       "fitted": model.fitted})
    nodes = [(t, n, int(tree.feature[n]), int(tree.bin[n]), float(tree.value[n]), None)
             for t, tree in enumerate(model.trees) for n in range(1, _NODES)]
    spark.createDataFrame([(-1, 0, -1, 0, 0.0, head), *nodes],
                          "tree int, node int, feature int, bin int, value double, head string") \
        .coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> Boosted:
    trees: dict[int, Tree] = {}
    for r in spark.read.parquet(path).collect():  # at most rounds x 31 rows
        if r["tree"] < 0:
            head = json.loads(r["head"])
            continue
        t = trees.setdefault(r["tree"], Tree(np.full(_NODES, -1, np.int64), np.zeros(_NODES, np.int64), np.zeros(_NODES)))
        t.feature[r["node"]], t.bin[r["node"]], t.value[r["node"]] = r["feature"], r["bin"], r["value"]
    return Boosted(head["features"], head["cuts"], head["base"], [trees[i] for i in sorted(trees)], head["losses"],
                   head["fitted"])
