"""Quality classifier by positive-unlabelled learning.

A logistic model over text features minimises the non-negative unbiased risk
    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])
where P are trusted positives (training rows labelled 1), U is unlabelled web text
(every document, whatever its label), and the class prior is estimated as the
share of positives among the labelled training rows. When the bracket is negative
the step goes the other way on it, as the non-negative estimator asks, so U is
not over-fitted. Negative labels are used for the prior only.

Features are computed in one pass over whole texts and written once; their mean and
deviation are of all rows. The gradient steps use bounded samples (``FIT_ROWS`` rows of P
and of U, drawn row by row); scoring is a pass over all features. Inputs of a score are
text features only.

Defined results: null texts are empty; empty texts have all-zero shares and are
scored like any other; repeated rows are scored alike, repeated labels of an id
count once (the larger); without positives every score is the estimated prior
(1 if nothing is labelled), so nothing is rejected unseen; very long texts are read
whole, part by part; ties do not occur (rows are scored, not ordered); an empty table gives
no rows; the result has its own columns only, and ``keep_quality`` keeps all of ``df``'s,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import binary_values, text_key, without, word_lists, written

#: Rows of positives and of unlabelled text that the model is fitted on, at most about.
FIT_ROWS = 20_000
THRESHOLD = 0.3
#: Chosen by the log-loss of a model fitted on remainders 2 to 4 of the id's hash and
#: measured on remainder 1 (labelled training rows only).
STEPS, RATE, PENALTY = 600, 0.1, 1e-5

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    """Byte classes: lower, upper, digit, space, line end, other control, beyond ASCII,
    and one per punctuation mark."""
    kind = np.full(256, 5)
    kind[128:] = 6
    kind[ord("a"):ord("z") + 1], kind[ord("A"):ord("Z") + 1], kind[ord("0"):ord("9") + 1] = 0, 1, 2
    kind[ord(" ")], kind[ord("\n")] = 3, 4
    for i, c in enumerate(_MARKS):
        kind[c] = 7 + i
    return kind


CLASSES = _classes()
N_CLASSES = 7 + len(_MARKS)
N_FEATURES = N_CLASSES + 6


def features(text: bytes | None) -> np.ndarray:
    """Square roots of byte-class shares, and shape: length, word length, distinct
    words, words that end in a mark, upper-case words, repeated lines."""
    text = text or b""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    counts = np.zeros(256, np.int64)
    for at in range(0, len(text), 1 << 22):
        counts += np.bincount(np.frombuffer(text[at:at + (1 << 22)], np.uint8), minlength=256)
    out[:N_CLASSES] = np.sqrt(np.bincount(CLASSES, counts, N_CLASSES) / len(text))
    words, marked, upper, distinct = 0, 0, 0, set()
    for part in word_lists(text):
        words += len(part)
        marked += sum(1 for w in part if w[-1] in _MARKS)
        upper += sum(1 for w in part if w.isupper())
        distinct.update(map(hash, part))
    lines = [line for line in text.split(b"\n") if line]
    if words:
        out[N_CLASSES:] = (np.log1p(len(text)) / 10, min(len(text) / words, 40) / 10, len(distinct) / words,
                           marked / words, upper / words, 1 - len(set(lines)) / max(len(lines), 1))
    return out


def feature_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, x): the features of every row as packed 32-bit floats; ``key`` is of its text."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("x", pa.binary())])

    def run(batches):
        for b in batches:
            xs = [features(t).tobytes() for t in binary_values(b.column("t"))]
            yield pa.record_batch([b.column("id").cast(pa.int64()), b.column("key"), pa.array(xs, pa.binary())],
                                  schema=schema)

    return df.select(F.col(id_col).cast("bigint").alias("id"), text_key(text_col).alias("key"),
                     F.col(text_col).alias("t")).mapInArrow(run, "id bigint, key bigint, x binary")


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """About ``most`` of the written rows, each drawn on its own (all rows, if fewer), as a
    matrix; null or much repeated ids do not come together."""
    n = rows.count()
    if n > most:
        rows = rows.sample(fraction=most / n, seed=17)
    got = [np.frombuffer(r["x"], np.float32) for r in rows.select("x").toLocalIterator()]
    return np.array(got, np.float64).reshape(len(got), N_FEATURES)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature over all rows: sums per task, added by Spark."""
    def run(batches):
        n, s, q = 0, np.zeros(N_FEATURES), np.zeros(N_FEATURES)
        for b in batches:
            x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
            n, s, q = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(N_FEATURES)), pa.array(np.full(N_FEATURES, n)), pa.array(s), pa.array(q)],
                              names=["i", "n", "s", "q"])

    sums = rows.mapInArrow(run, "i bigint, n bigint, s double, q double").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("i").collect()
    n, s, q = (np.array([r[c] for r in sums], np.float64) for c in "nsq")
    if not len(n) or not n[0]:
        return np.zeros(N_FEATURES), np.ones(N_FEATURES)
    mean = s / n
    return mean, np.sqrt(np.maximum(q / n - mean * mean, 0)) + 1e-3


class Model:
    """Logistic model over standardised features and their squares (text can be too
    short or too long, hold too few or too many of a byte class)."""

    def __init__(self, mean, scale, weights, bias):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias

    @staticmethod
    def inputs(x: np.ndarray, mean, scale) -> np.ndarray:
        z = np.clip((x - mean) / scale, -8, 8)
        return np.hstack([z, np.minimum(z * z, 16) / 4])

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.inputs(x, self.mean, self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_non_negative(pos: np.ndarray, unl: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray) -> Model:
    """Adam over the full samples, standardised by the whole table's ``mean`` and ``scale``;
    a negative bracket is stepped back from."""
    if not len(pos) or not len(unl) or prior >= 1:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), float(np.log(p / (1 - p))))
    one = lambda x: np.hstack([Model.inputs(x, mean, scale), np.ones((len(x), 1))])
    p, u = one(pos), one(unl)
    w = np.zeros(2 * N_FEATURES + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        sp, su = 1 / (1 + np.exp(-np.clip(p @ w, -40, 40))), 1 / (1 + np.exp(-np.clip(u @ w, -40, 40)))
        positive = prior * p.T @ (sp - 1) / len(p)
        rest = u.T @ su / len(u) - prior * p.T @ sp / len(p)
        bracket = (-np.log1p(-np.minimum(su, 1 - 1e-12))).mean() - prior * (-np.log1p(-np.minimum(sp, 1 - 1e-12))).mean()
        g = (positive + rest if bracket >= 0 else -rest) + PENALTY * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w[:-1], float(w[-1]))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", train_when=None, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(id, key, score) per row of ``df``; ``key`` is of its text. ``train_when`` is a
    condition on the column ``id``: labels are learned from those rows only."""
    rows = written(feature_table(df, id_col, text_col), "quality-features")
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .where("id IS NOT NULL AND y IS NOT NULL")
    if train_when is not None:
        known = known.where(train_when)
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    prior = known.agg(F.avg("y").alias("p")).first()["p"]
    positives = rows.join(known.where("y = 1").select("id"), "id", "left_semi")
    model = fit_non_negative(_sample(positives, fit_rows), _sample(rows, fit_rows), 1.0 if prior is None else prior, *_moments(rows))
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
            yield pa.record_batch([b.column("id"), b.column("key"), pa.array(model.scores(x.astype(np.float64)))],
                                  schema=schema)

    return rows.mapInArrow(run, "id bigint, key bigint, score double")


def keep_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 train_when=None, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` without the rows scored below ``threshold``, each judged by its own text."""
    scored = score_quality(df, labels, id_col, text_col, train_when=train_when)
    return without(df, scored.where(F.col("score") < threshold), id_col, text_col)
