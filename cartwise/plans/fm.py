"""Factorisation machine with distributed parameters, by block coordinate descent.

    y = b + sum_f x_f w_f + sum_{f<g} (v_f . v_g) x_f x_g

over the fields of a row: a categorical field has one active feature per row (its value,
x = 1), a numeric column is a field with one feature (x = its standardised value). Given
everything else, y is linear in the parameters of one field, and no row has two features
of a categorical field, so all its features are solved at once, each from its own rows:
one map-side combined aggregate of the normal equations per feature, one small solve per
feature inside the tasks, and one join that puts the new parameters onto the rows. The
parameters of millions of ids are a table, never a vector on the driver or in one task; a
value with a third of all rows is one partial sum per task. A numeric column is one pass:
each task applies the steps since the last write to its rows and gives one row of sums.

The logistic loss is majorised by its quadratic bound (curvature 1/4), so each solve lowers
the penalised loss and a sweep over the fields never raises it. Rows carry their score and
factor sums and are written after each categorical field and every ``WRITE_EVERY`` numeric
columns; a lost task reads the last table again.

Null categories are a feature of their own, null numbers count as the column's mean; no
rows give an empty result.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.constants import MF_RANK
from cartwise.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WRITE_EVERY = 8
PENALTY = 1.0
_LIST = T.ArrayType(T.DoubleType())


@dataclass
class Fitted:
    """``rows``: the input columns with ``score``; ``losses``: the penalised loss before the
    first sweep and after each; ``tables``: field -> (feature, w, v) of a categorical field;
    ``numbers``: numeric column -> [w, *v]."""

    rows: DataFrame
    losses: list[float]
    tables: dict[str, DataFrame]
    numbers: dict[str, np.ndarray]


def _start(feature, rank: int, seed: int, field: int):
    """Small factors from a hash of the feature, the same for any partitioning."""
    return F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda i: (
        F.pmod(F.xxhash64(F.lit(seed), F.lit(field), feature, i), F.lit(2_000_001)) / 1_000_000.0 - 1.0) * 0.05)


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (p, q) -> p * q), 0D, (s, e) -> s + e)"


#: Working response: a step of four times the residual is the minimum of the quadratic bound.
_WORKING = "y + 4D * (label - 1D / (1D + exp(-y)))"


def _equations(state: DataFrame, x: str, w: str, v: str, by: list[str], rank: int) -> DataFrame:
    """Normal equations of a field per ``by``: sums of d d' and d r with d = x [1, s], s the
    factor sums of the other fields and r what they leave of the working response."""
    rows = state.select(*by, F.expr(x).alias("x"), F.expr(f"zip_with(q, {v}, (a, b) -> a - {x} * b)").alias("s"),
                        F.expr(f"{_WORKING} - y + {x} * {w}").alias("r0"), F.expr(v).alias("v"))
    rows = rows.withColumn("r", F.expr(f"r0 + x * {_dot('v', 's')}"))
    d = [F.col("x")] + [F.col("x") * F.col("s")[i] for i in range(rank)]
    rows = rows.select(*by, "r", *[c.alias(f"d{i}") for i, c in enumerate(d)])
    sums = [F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"a{i}_{j}") for i in range(rank + 1) for j in range(i + 1)]
    sums += [F.sum(F.col(f"d{i}") * F.col("r")).alias(f"b{i}") for i in range(rank + 1)]
    return rows.groupBy(*by).agg(*sums)


def _solved(names: list[str], rank: int, penalty: float, columns) -> np.ndarray:
    """(n x (rank + 1)) parameters from the columns of the sums."""
    n = len(columns[names[0]])
    a, b = np.zeros((n, rank + 1, rank + 1)), np.zeros((n, rank + 1, 1))
    for i in range(rank + 1):
        b[:, i, 0] = columns[f"b{i}"]
        for j in range(i + 1):
            a[:, i, j] = a[:, j, i] = columns[f"a{i}_{j}"]
    return np.linalg.solve(a + 4 * penalty * np.eye(rank + 1), b)[:, :, 0]


def _names(rank: int) -> list[str]:
    return [f"b{i}" for i in range(rank + 1)] + [f"a{i}_{j}" for i in range(rank + 1) for j in range(i + 1)]


def _solver(rank: int, penalty: float):
    names = _names(rank)

    def run(batches):
        for b in batches:
            if b.num_rows:
                t = _solved(names, rank, penalty, {n: b.column(n).to_numpy(zero_copy_only=False) for n in names})
                yield pa.RecordBatch.from_arrays([b.column("feature"), pa.array(t[:, 0]), pa.array(
                    t[:, 1:].tolist(), pa.list_(pa.float64()))], names=["feature", "w", "v"])

    return run


def _moved(state: DataFrame, x: str, old: tuple[str, str], new: tuple[str, str]) -> dict:
    """Score and factor sums after a field's parameters went from ``old`` to ``new``."""
    s = f"zip_with(q, {old[1]}, (a, b) -> a - {x} * b)"
    return {"y": F.expr(f"y - {x} * ({old[0]} + {_dot(old[1], s)}) + {x} * ({new[0]} + {_dot(new[1], s)})"),
            "q": F.expr(f"zip_with({s}, {new[1]}, (a, b) -> a + {x} * b)")}


def _arrays(column, rank: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)


def _lists(values: np.ndarray) -> pa.Array:
    edges = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.ravel(), pa.float64()))


def _stepped(batch, steps, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and factor sums of a batch after the numeric ``steps`` (column, old, new)."""
    y, q = batch.column("y").to_numpy(zero_copy_only=False), _arrays(batch.column("q"), rank)
    for name, old, new in steps:
        x = batch.column(name).to_numpy(zero_copy_only=False)
        s = q - x[:, None] * old[1:]
        y = y - x * (old[0] + s @ old[1:]) + x * (new[0] + s @ new[1:])
        q = s + x[:, None] * new[1:]
    return y, q


def _started(base: float, theta: dict, categorical: list[str], rank: int):
    """Scores and factor sums of the first parameters, whose linear parts are zero: half of
    (sum)^2 less the squares."""

    def run(batches):
        for b in batches:
            q, squares = np.zeros((b.num_rows, rank)), np.zeros(b.num_rows)
            for c in categorical:
                part = _arrays(b.column(c), rank)
                q, squares = q + part, squares + (part * part).sum(axis=1)
            for n, t in theta.items():
                part = b.column(n).to_numpy(zero_copy_only=False)[:, None] * t[1:]
                q, squares = q + part, squares + (part * part).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(q), pa.array(base + ((q * q).sum(axis=1) - squares) / 2)],
                                             [*b.schema.names, "q", "y"])

    return run


def _kept(steps, rank: int):
    """The rows with ``steps`` applied."""

    def run(batches):
        for b in batches:
            y, q = _stepped(b, steps, rank)
            done = {"y": pa.array(y), "q": _lists(q)}
            yield pa.RecordBatch.from_arrays([done.get(n, c) for n, c in zip(b.schema.names, b.columns)], b.schema.names)

    return run


def _number_equations(name: str, t: np.ndarray, steps, rank: int):
    """The normal equations of a numeric column: one row of sums per task with rows. As in
    ``_equations``, rows without a label count on the left side only."""
    names = _names(rank)

    def run(batches):
        a, b, rows, told = np.zeros((rank + 1, rank + 1)), np.zeros(rank + 1), 0, 0
        for batch in batches:
            y, q = _stepped(batch, steps, rank)
            x, label = batch.column(name).to_numpy(zero_copy_only=False), batch.column("label")
            s = q - x[:, None] * t[1:]
            d = np.hstack([x[:, None], x[:, None] * s])
            with np.errstate(over="ignore"):
                r = 4 * (label.to_numpy(zero_copy_only=False) - 1 / (1 + np.exp(-y))) + x * t[0] + x * (s @ t[1:])
            known = label.is_valid().to_numpy(zero_copy_only=False)
            a, b = a + d.T @ d, b + d[known].T @ r[known]
            rows, told = rows + len(x), told + int(known.sum())
        if rows:
            values = [v if told else None for v in b.tolist()] + [float(a[i, j]) for i in range(rank + 1) for j in range(i + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.float64()) for v in values], names)

    return run


def fit_fm(rows: DataFrame, categorical=("role_id", "item_id"), numeric=(), rank: int = MF_RANK, sweeps: int = 3,
           penalty: float = PENALTY, seed: int = 3) -> Fitted:
    """Fit ``label`` (0 / 1) of ``rows`` and score them."""
    rows = materialize(rows.select(*categorical, *numeric, F.col("label").cast("double").alias("label")))
    facts = rows.agg(F.avg("label").alias("p"), *[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(numeric)
                                                  for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    p = min(max(facts["p"] or 0.5, 1e-6), 1 - 1e-6)
    base = float(np.log(p / (1 - p)))
    scaled = {f"x{i}": F.coalesce((F.col(c).cast("double") - F.lit(facts[f"m{i}"])) / F.lit(facts[f"s{i}"] or 1.0), F.lit(0.0))
              for i, c in enumerate(numeric)}
    rng = np.random.default_rng(seed)
    theta = {c: np.concatenate([[0.0], (rng.random(rank) - 0.5) * 0.1]) for c in numeric}
    state = rows.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(f"k{i}") for i, c in enumerate(categorical)])
    state = state.withColumns({f"v{i}": _start(F.col(f"k{i}"), rank, seed, i) for i in range(len(categorical))})
    state = state.withColumns({f"w{i}": F.lit(0.0) for i in range(len(categorical))})
    theta = {f"x{i}": theta[c] for i, c in enumerate(numeric)}
    state = state.select("*", *[c.alias(n) for n, c in scaled.items()])
    state = materialize(state.mapInArrow(_started(base, theta, [f"v{i}" for i in range(len(categorical))], rank), T.StructType(
        [*state.schema.fields, T.StructField("q", _LIST), T.StructField("y", T.DoubleType())])).drop(*scaled))
    tables = {c: materialize(state.select(F.col(f"k{i}").alias("feature"), f"w{i}", f"v{i}").distinct().select(
        "feature", F.col(f"w{i}").alias("w"), F.col(f"v{i}").alias("v"))) for i, c in enumerate(categorical)}

    def loss() -> float:
        fit = state.agg(F.sum(F.expr("log1p(exp(-abs(y))) + greatest(y, 0D) - label * y")).alias("n")).first()["n"] or 0.0
        size = sum(t.agg(F.sum(F.expr(f"w * w + {_dot('v', 'v')}")).alias("n")).first()["n"] or 0.0 for t in tables.values())
        return float(fit + penalty / 2 * (size + sum(float(t @ t) for t in theta.values())))

    names = _names(rank)
    losses = [loss()]
    for _ in range(sweeps):
        for i, c in enumerate(categorical):
            sums = _equations(state, "1D", f"w{i}", f"v{i}", [f"k{i}"], rank).withColumnRenamed(f"k{i}", "feature")
            tables[c] = materialize(sums.mapInArrow(_solver(rank, penalty), "feature string, w double, v array<double>"))
            joined = state.join(tables[c].select(F.col("feature").alias(f"k{i}"), F.col("w").alias("_w"), F.col("v").alias("_v")), f"k{i}")
            moved = joined.withColumns(_moved(joined, "1D", (f"w{i}", f"v{i}"), ("_w", "_v")))
            state = materialize(moved.withColumns({f"w{i}": F.col("_w"), f"v{i}": F.col("_v")}).drop("_w", "_v"))
        steps = []
        for i, n in enumerate(theta):
            read = state.select("label", "y", "q", *[scaled[m].alias(m) for m in [*(m for m, _, _ in steps), n]])
            sums = read.mapInArrow(_number_equations(n, theta[n], steps, rank), ", ".join(f"{m} double" for m in names))
            sums = sums.agg(*[F.sum(m).alias(m) for m in names]).first()  # one row
            if sums["b0"] is not None:
                new = _solved(names, rank, penalty, {m: np.array([sums[m]]) for m in names})[0]
                steps.append((n, theta[n], new))
                theta[n] = new
            if steps and (len(steps) == WRITE_EVERY or i + 1 == len(theta)):
                read = state.select("*", *[scaled[m].alias(m) for m, _, _ in steps])
                state = materialize(read.mapInArrow(_kept(steps, rank), read.schema).drop(*[m for m, _, _ in steps]))
                steps = []
        losses.append(loss())
    scored = state.select(*categorical, *numeric, "label", F.expr("1D / (1D + exp(-y))").alias("score"))
    return Fitted(scored, losses, tables, {c: theta[f"x{i}"] for i, c in enumerate(numeric)})
