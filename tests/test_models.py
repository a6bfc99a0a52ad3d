"""Model checks: special functions, prior recovery, seeds, cold start."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwise.functions.special import digamma, trigamma
from cartwise.operators.smoothing import fit_prior, smoothed_ctr


def test_digamma_trigamma(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (10.0,)], "x double")
    got = df.select(digamma("x").alias("d"), trigamma("x").alias("t")).collect()
    gamma = 0.5772156649015329
    assert got[0].d == pytest.approx(-gamma - 2 * math.log(2), abs=1e-10)
    assert got[1].d == pytest.approx(-gamma, abs=1e-10)
    assert got[2].d == pytest.approx(2.251752589066721, abs=1e-10)
    assert got[1].t == pytest.approx(math.pi ** 2 / 6, abs=1e-9)
    assert got[0].t == pytest.approx(math.pi ** 2 / 2, abs=1e-9)


def test_prior_recovers_known_beta(spark):
    rng = np.random.default_rng(0)
    p = rng.beta(100, 50, 1000)
    n = np.floor(rng.random(1000) * 10000) + 1
    c = np.round(n * p)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(n, c)], "imps double, clks double")
    prior = fit_prior(df)
    assert prior.converged and prior.rounds < 20
    assert prior.alpha / (prior.alpha + prior.beta) == pytest.approx(2 / 3, abs=0.01)
    assert 70 < prior.alpha < 150 and 35 < prior.beta < 75
    ctr = smoothed_ctr(df.limit(1), prior.alpha, prior.beta).first()
    assert ctr.ctr == pytest.approx((ctr.clks + prior.alpha) / (ctr.imps + prior.alpha + prior.beta))


def test_unseen_pair_scores_minus_two(spark, sf_dir):
    from cartwise.plans.factorize import fit_factors, interactions, pair_score
    lg = E._logs(spark, sf_dir)
    fs = fit_factors(interactions(lg.clicks, E.TRAIN_ASOF))
    rows = spark.createDataFrame([(10 ** 9, 1), (10 ** 9 + 1, 2)], "role_id bigint, item_id bigint")
    assert {r.fm for r in pair_score(rows, fs).collect()} == {-2.0}
    assert fs.roles.select(F.size("features")).distinct().first()[0] == 10


def test_holdout_is_deterministic(spark, sf_dir):
    a = E.q_holdout_split(spark, sf_dir).orderBy("role_id", "item_id").collect()
    b = E.q_holdout_split(spark, sf_dir).orderBy("role_id", "item_id").collect()
    assert a == b
    frac = sum(r.is_val for r in a) / len(a)
    assert 0.05 < frac < 0.4


def test_gbt_ranks_every_buyer(spark, sf_dir):
    ranked = E.q_gbt_score(spark, sf_dir)
    assert ranked.where(F.col("score").isNull()).count() == 0
    assert ranked.select("role_id").distinct().count() == E.q_recommend_list(spark, sf_dir) \
        .select("role_id").distinct().count()


def test_fixed_point_parity_mode(spark):
    rng = np.random.default_rng(1)
    p = rng.beta(20, 10, 400)
    n = np.floor(rng.random(400) * 500) + 1
    c = np.round(n * p)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(n, c)], "imps double, clks double")
    newton = fit_prior(df)
    fixed = fit_prior(df, method="fixed_point", max_rounds=15)
    assert fixed.rounds == 15 and not fixed.converged
    # from (1, 1) the map climbs toward the maximum and keeps the ratio close
    assert 1.0 < fixed.alpha < newton.alpha and 1.0 < fixed.beta < newton.beta
    assert fixed.alpha / (fixed.alpha + fixed.beta) == pytest.approx(
        newton.alpha / (newton.alpha + newton.beta), abs=0.05)


def test_fm_hashed_features_bound_the_width(spark, sf_dir):
    from cartwise.plans.models import fm_classify, vectorize
    rows = E.q_training_rows(spark, sf_dir)
    v = vectorize(rows, ["role_id", "item_id"], ["cnt_21"], hash_dim=1 << 10)
    assert v.select("features").first()[0].size == (1 << 10) + 1  # hashed ids + cnt_21
    out = fm_classify(rows, numeric=("cnt_21",), hash_dim=1 << 10, max_iter=3)
    assert out.count() == rows.count()


def test_cold_start_roles_get_popularity_order(spark):
    from cartwise.plans.factorize import fallback_positions, fit_factors, recommend_fallback
    rows = [(1, 10, 3), (1, 11, 1), (2, 10, 2), (2, 12, 5), (3, 11, 1), (3, 12, 1), (4, 12, 2)]
    train = spark.createDataFrame([(r, i, "2024-01-20", n) for r, i, n in rows],
                                  "role_id bigint, item_id bigint, dt string, num bigint")
    fs = fit_factors(train, rank=2, epochs=3)
    catalog = spark.createDataFrame([(10,), (11,), (12,), (13,)], "item_id bigint")
    test_roles = spark.createDataFrame([(1,), (99,)], "role_id bigint")
    out = {(r.role_id, r.item_id): (r.position, r.source) for r in recommend_fallback(test_roles, fs, catalog).collect()}
    # known role: every catalog item that has a vector (13 never seen), positions 0..2
    assert sorted(p for (r, _), (p, _s) in out.items() if r == 1) == [0, 1, 2]
    assert {s for (r, _), (_p, s) in out.items() if r == 1} == {"mf"}
    # unknown role: interaction rows per item, most first, ties by item: 12 (4 rows), 10, 11 (2 each)
    assert [i for (r, i), _ in sorted(out.items(), key=lambda kv: kv[1][0]) if r == 99] == [12, 10, 11]
    # positions of purchased pairs alone: the same, without a list per unseen role
    bought = spark.createDataFrame([(1, 11), (1, 11), (1, 13), (99, 11), (99, 13)], "role_id bigint, item_id bigint")
    got = {(r.role_id, r.item_id): r.position for r in fallback_positions(bought, fs, catalog).collect()}
    assert got == {k: out[k][0] for k in [(1, 11), (99, 11)]}
    assert {s for (r, _), (_p, s) in out.items() if r == 99} == {"popular"}


def test_keyed_factor_features_per_day(spark, sf_dir):
    from cartwise.plans.factorize import factor_features_days, fit_factors, interactions, with_factor_features
    from cartwise.plans.training import training_rows
    logs = E._logs(spark, sf_dir)
    days = ["2024-01-24", "2024-01-25"]
    rows = training_rows(logs, days)
    out = factor_features_days(rows, logs.clicks, days, rank=3, epochs=2)
    assert out.count() == rows.count()
    assert {"fm", "0_user_fm", "2_item_fm"} <= set(out.columns)
    # a day's keyed result equals the single-day attachment with that day's vectors
    one = out.where(F.col("asof") == F.lit("2024-01-25").cast("date"))
    single = with_factor_features(training_rows(logs, "2024-01-25"),
                                  fit_factors(interactions(logs.clicks, "2024-01-25"), rank=3, epochs=2), rank=3)
    assert one.count() == single.count()
    assert one.where(F.col("fm") == -2.0).count() == single.where(F.col("fm") == -2.0).count()


def test_fit_decides_from_the_likelihood_not_from_moments(spark):
    """A long tail of low-impression rows makes the moment estimate useless; the maximum is finite."""
    rows = [(2.0, 1.0)] * 1000 + [(1000.0, 300.0)] * 10 + [(1000.0, 700.0)] * 10
    prior = fit_prior(spark.createDataFrame(rows, "imps double, clks double"))
    assert prior.converged and prior.finite
    assert prior.alpha == pytest.approx(13.698, abs=1e-2) and prior.beta == pytest.approx(13.698, abs=1e-2)


def test_fit_reports_no_finite_maximum(spark):
    rows = [(400.0, 200.0 + i % 3) for i in range(100)]
    prior = fit_prior(spark.createDataFrame(rows, "imps double, clks double"))
    assert not prior.finite and not prior.converged
    assert prior.alpha / (prior.alpha + prior.beta) == pytest.approx(0.5025, abs=1e-3)


def test_fit_goes_on_where_the_point_beats_the_limit(spark):
    """Two opposite groups and one even row: the slope at infinity is near zero, the maximum far from there."""
    rows = [(2.0, 0.0)] * 250 + [(2.0, 2.0)] * 250 + [(1000.0, 500.0)]
    df = spark.createDataFrame(rows, "imps double, clks double")

    def mean(a, b):
        up = lambda x, n: math.lgamma(x + n) - math.lgamma(x)
        return sum(up(a, c) + up(b, n - c) - up(a + b, n) for n, c in rows) / len(rows)

    near = max(mean(x, x) for x in np.geomspace(1e-4, 1, 400))
    for start in (None, (0.1, 0.1), (1.0, 1.0)):
        prior = fit_prior(df, start=start)
        assert prior.finite and prior.converged
        assert prior.alpha == pytest.approx(prior.beta, rel=1e-3)
        assert mean(prior.alpha, prior.beta) >= near - 1e-4


def test_log_gamma(spark):
    from cartwise.functions.special import log_gamma
    xs = [0.001, 0.5, 1.0, 2.5, 40.0, 1e6]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", log_gamma("x").alias("g")).collect()
    assert all(r.g == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-10) for r in got)


def test_neighbours_of_2_53_stay_apart(spark):
    from cartwise.plans.factorize import dense_ids, fit_factors
    from cartwise.plans.models import item_onehot
    big = 2 ** 53
    df = spark.createDataFrame([(big, big + 1, 3), (big + 1, big, 2), (big + 2, big + 1, 1)],
                               "role_id bigint, item_id bigint, num bigint")
    got = {(r.role_id, r.item_id): (r.role_id_index, r.item_id_index) for r in dense_ids(df).collect()}
    assert got == {(big, big + 1): (0, 1), (big + 1, big): (1, 0), (big + 2, big + 1): (2, 1)}
    assert fit_factors(df).roles.count() == 3
    assert item_onehot(df).select("item_id_vec").distinct().count() == 2


def test_the_fit_ends_not_worse_than_the_constant_rate(spark, sf_dir):
    from cartwise.plans.models import holdout_losses, train_gbt, tree_count
    from cartwise.plans.training import training_rows
    from cartwise.session import materialize
    rows = materialize(training_rows(E._logs(spark, sf_dir), E.MODEL_TRAIN_DAYS))
    model, _ = train_gbt(rows)
    losses = holdout_losses(model)
    assert model.fitted == tree_count(model) + 20
    assert losses[tree_count(model)] == min(losses) <= losses[0]


def test_main_path_reports_every_purchase(spark, sf_dir):
    import __spark_entry__ as E
    from cartwise.constants import HIT_KS
    from cartwise.plans.recommend import day_purchases
    r = E.q_gbt_hit_revenue_at_k(spark, sf_dir).collect()
    assert len(r) == 1
    hits = [r[0][f"hit_{k}"] for k in HIT_KS]
    lg = E._logs(spark, sf_dir)
    assert hits == sorted(hits) and hits[-1] <= r[0]["total"]
    assert r[0]["total"] + r[0]["missed"] + r[0]["skipped"] == day_purchases(lg.buys, lg.active_roles, E.TEST_ASOF).count()


def test_branch_queries_reach_their_branch(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    assert E.q_interaction_weight_solo(spark, sf).where("num_s = 1").count() > 0
    assert E.q_hit_revenue_skipped(spark, sf).first()["skipped"] > 0
    assert E.q_item_catalog_shifted(spark, sf).count() < E._data(spark, sf).items().count()
    filled = E.q_avatar_text(spark, sf).where("gender IS NOT NULL AND tshirt IS NOT NULL AND hat IS NOT NULL AND hair IS NOT NULL")
    assert 0 < filled.count() < E._data(spark, sf).avatar_log().count()
    seen = {r.unseen for r in E.q_test_rows_unseen(spark, sf).select("unseen").distinct().collect()}
    assert seen == {True, False}
