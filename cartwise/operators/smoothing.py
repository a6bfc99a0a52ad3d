"""Beta-binomial CTR smoothing.

The prior (alpha, beta) maximises the beta-binomial likelihood of
(impressions, clicks) pairs. One pass builds three count histograms
(clicks, impressions - clicks, impressions), checkpointed; each round is then
one aggregate of digamma / trigamma sums over those histograms and returns
six numbers to the driver. Newton steps (Minka, "Estimating a Dirichlet
distribution", 2000) reach the maximum in a handful of rounds; the original
fixed-point map is kept as ``method="fixed_point"``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import SMOOTH_EPSILON, SMOOTH_MAX_ROUNDS, SMOOTH_START
from cartwise.functions.special import digamma, log_gamma, trigamma
from cartwise.session import materialize


@dataclass
class Prior:
    alpha: float
    beta: float
    rounds: int
    converged: bool
    method: str
    finite: bool = True  # the likelihood has a finite maximum


def count_histograms(counts: DataFrame, imps: str = "imps", clks: str = "clks") -> DataFrame:
    """(kind, v, m): multiplicity ``m`` of each value of c, n - c and n."""
    c, n = F.col(clks).cast("double"), F.col(imps).cast("double")
    kinds = F.array(F.struct(F.lit("c").alias("kind"), c.alias("v")),
                    F.struct(F.lit("f").alias("kind"), (n - c).alias("v")),
                    F.struct(F.lit("n").alias("kind"), n.alias("v")))
    rows = counts.where(F.col(imps).isNotNull() & F.col(clks).isNotNull()).select(F.explode(kinds).alias("s"))
    return rows.groupBy("s.kind", "s.v").agg(F.count(F.lit(1)).cast("double").alias("m"))


def _sums(hist: DataFrame, a: float, b: float, second: bool) -> dict:
    """Digamma (and trigamma) sums at (a, b). The parameters arrive as a one-row
    broadcast side, not as literals, so the generated code is identical in every
    round and compiled once."""
    params = hist.sparkSession.createDataFrame([(0, float(a), float(b))], "_k int, _a double, _b double")
    h = hist.withColumn("_k", F.lit(0)).join(F.broadcast(params), "_k")
    kind, v, m, pa, pb = F.col("kind"), F.col("v"), F.col("m"), F.col("_a"), F.col("_b")
    arg = F.when(kind == "c", v + pa).when(kind == "f", v + pb).otherwise(v + pa + pb)
    base = F.when(kind == "c", pa).when(kind == "f", pb).otherwise(pa + pb)
    h = h.select("kind", "m", arg.alias("arg"), base.alias("base"))
    exprs = [F.sum(F.when(F.col("kind") == k, F.col("m") * (digamma("arg") - digamma("base")))).alias(f"d_{k}")
             for k in "cfn"]
    if second:
        exprs += [F.sum(F.when(F.col("kind") == k, F.col("m") * (trigamma("arg") - trigamma("base"))))
                  .alias(f"t_{k}") for k in "cfn"]
    row = h.agg(*exprs).first()
    return {k: (row[k] or 0.0) for k in row.asDict()}


def moment_start(counts: DataFrame, imps: str = "imps", clks: str = "clks") -> tuple[float, float] | None:
    """Method-of-moments (alpha, beta) for binomial counts with varying trials.

    With p = clks / imps: rho = (Var p - mu(1-mu) E[1/n]) / (mu(1-mu)(1 - E[1/n]))
    estimates 1 / (alpha + beta + 1). ``None`` when rho <= 0: the estimate has no
    solution (the likelihood may have a maximum all the same).
    """
    n = F.col(imps).cast("double")
    p = F.try_divide(F.col(clks).cast("double"), n)
    row = counts.where(F.col(imps) > 0).agg(F.avg(p).alias("mu"), F.var_samp(p).alias("var"),
                                            F.avg(1.0 / n).alias("inv_n")).first()
    mu, var, inv_n = row["mu"], row["var"], row["inv_n"]
    if mu is None or var is None or not 0 < mu < 1 or inv_n is None or inv_n >= 1:
        return SMOOTH_START
    binom = mu * (1 - mu)
    rho = (var - binom * inv_n) / (binom * (1 - inv_n))
    if rho <= 0:
        return None
    total = 1.0 / rho - 1.0 if rho < 1 else 1.0
    return mu * total, (1 - mu) * total


#: The mean log-likelihood of a row is within this of its limit at infinite concentration.
LIMIT_GAIN = 1e-4


def limit_slope(hist: DataFrame) -> float:
    """D with mean logL(mu, s) = mean logL(mu, infinity) + D / (2 s) + O(1 / s^2) at the
    pooled rate mu, s = alpha + beta: the mean of c(c-1)/mu + f(f-1)/(1-mu) - n(n-1). A
    positive D proves a finite maximum: some finite s beats the limit."""
    w = F.col("m") * F.col("v")
    row = hist.groupBy().agg(F.sum(F.when(F.col("kind") == "n", F.col("m"))).alias("rows"), *[F.sum(F.when(F.col("kind") == k, e)).alias(n) for k, e, n in (
        ("c", w, "c1"), ("n", w, "n1"), ("c", w * (F.col("v") - 1), "c2"), ("f", w * (F.col("v") - 1), "f2"),
        ("n", w * (F.col("v") - 1), "n2"))]).first()
    if not row["n1"] or not 0 < row["c1"] < row["n1"]:
        return 0.0
    mu = row["c1"] / row["n1"]
    return (row["c2"] / mu + row["f2"] / (1 - mu) - row["n2"]) / row["rows"]


def mean_log_likelihood(hist: DataFrame, a: float, b: float) -> float:
    """Mean log-likelihood of a row at (a, b), without the binomial coefficients."""
    kind, v = F.col("kind"), F.col("v")
    base = F.when(kind == "c", F.lit(float(a))).when(kind == "f", F.lit(float(b))).otherwise(F.lit(float(a + b)))
    gain = F.col("m") * (log_gamma(v + base) - log_gamma(base)) * F.when(kind == "n", -1).otherwise(1)
    row = hist.agg(F.sum(gain).alias("l"), F.sum(F.when(kind == "n", F.col("m"))).alias("rows")).first()
    return row["l"] / row["rows"]


def limit_log_likelihood(hist: DataFrame) -> float:
    """The same where the concentration is infinite: every row has the pooled rate."""
    row = hist.agg(*[F.sum(F.when(F.col("kind") == k, F.col("m") * F.col("v"))).alias(k) for k in "cfn"],
                   F.sum(F.when(F.col("kind") == "n", F.col("m"))).alias("rows")).first()
    part = lambda x: x * math.log(x / row["n"]) if x else 0.0
    return (part(row["c"]) + part(row["f"])) / row["rows"]


def fit_prior(counts: DataFrame, imps: str = "imps", clks: str = "clks", method: str = "newton",
              start=None, epsilon: float = SMOOTH_EPSILON, max_rounds: int = SMOOTH_MAX_ROUNDS) -> Prior:
    """Fit (alpha, beta); converged when both move less than ``epsilon`` (relative
    to their size once above 1) (R18, R34).

    Newton steps are taken in (log alpha, log beta) where the Hessian is negative
    definite, shortened until the slope along the step has not turned by more than
    it was; elsewhere one fixed-point step, which never lowers the likelihood. The
    start is the moment estimate, or (1, 1) where that has no solution.

    Without over-dispersion the likelihood keeps rising with alpha + beta. That is
    decided from the likelihood itself: ``limit_slope`` is not positive, and the point is
    not above the limit at infinite concentration but within ``LIMIT_GAIN`` of it. A point
    above the limit proves a finite maximum, and the fit goes on. The result without one
    has ``finite=False``; alpha / (alpha + beta) is the pooled rate.
    """
    hist = materialize(count_histograms(counts, imps, clks))  # written once, read every round
    if start is None:
        start = (moment_start(counts, imps, clks) if method == "newton" else None) or SMOOTH_START
    a, b = start
    slope, limit = limit_slope(hist), None
    last = None  # (point, step, slope along the step) of the Newton step being judged
    for rnd in range(1, max_rounds + 1):
        s = _sums(hist, a, b, second=method != "fixed_point")
        if s["d_n"] == 0:
            return Prior(a, b, rnd, False, method, False)
        fixed = (a * s["d_c"] / s["d_n"], b * s["d_f"] / s["d_n"])
        na, nb = fixed
        if method != "fixed_point":
            ga, gb = a * (s["d_c"] - s["d_n"]), b * (s["d_f"] - s["d_n"])  # gradient in the logs
            if last is not None:
                (oa, ob), (da, db), before = last
                if abs(ga * da + gb * db) > before:  # overshot: half the step from the same point
                    last = ((oa, ob), (da / 2, db / 2), before / 2)
                    a, b = oa * math.exp(da / 2), ob * math.exp(db / 2)
                    continue
            haa = a * a * (s["t_c"] - s["t_n"]) + ga
            hbb = b * b * (s["t_f"] - s["t_n"]) + gb
            hab = -a * b * s["t_n"]
            det = haa * hbb - hab * hab
            last = None
            if haa < 0 and det > 0 and math.isfinite(det):
                da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
                size = max(abs(da), abs(db), 1.0)
                da, db = da / size, db / size  # at most a factor e a round
                if ga * da + gb * db > 0:
                    na, nb = a * math.exp(da), b * math.exp(db)
                    last = ((a, b), (da, db), ga * da + gb * db)
        done = abs(na - a) < epsilon * max(1.0, abs(a)) and abs(nb - b) < epsilon * max(1.0, abs(b))
        a, b = na, nb
        if slope <= 0 and abs(slope) / (2 * (a + b)) < LIMIT_GAIN:
            if limit is None:
                limit = limit_log_likelihood(hist)
            left = limit - mean_log_likelihood(hist, a, b)
            if 0 <= left < LIMIT_GAIN:
                return Prior(a, b, rnd, False, method, False)
        if done:
            return Prior(a, b, rnd, True, method, True)
    return Prior(a, b, max_rounds, False, method, slope > 0)


def smoothed_ctr(counts: DataFrame, alpha: float, beta: float, imps: str = "imps", clks: str = "clks",
                 out: str = "ctr") -> DataFrame:
    """Posterior-mean CTR ``(C + alpha) / (I + alpha + beta)`` (M2)."""
    return counts.withColumn(out, (F.col(clks) + F.lit(float(alpha)))
                             / (F.col(imps) + F.lit(float(alpha)) + F.lit(float(beta))))


def prior_frame(spark, prior: Prior) -> DataFrame:
    return spark.createDataFrame([(prior.alpha, prior.beta, prior.rounds, prior.converged, prior.method,
                                   prior.finite)],
                                 "alpha double, beta double, rounds int, converged boolean, method string, finite boolean")
