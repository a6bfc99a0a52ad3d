"""

Every query reads the shared tables through ``cartwise.sources.tables.ShopData``
(FIXTURES §2 mapping) and runs over whole tables. As-of days: 2024-01-25 for
training-side queries, 2024-01-30 for test-side ones.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# the package sits next to this file; make it importable however this module
# is loaded (functions that run inside tasks are shipped by value)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.constants import ITEM_RATE_PRIOR
from cartwise.session import ensure_checkpoint_dir

try:  # the training-data operators; the rest works without them
    from cartwise.llm import queries as _llm
except ModuleNotFoundError as e:
    if not (e.name or "").startswith("cartwise.llm"):
        raise
    _llm = None
from cartwise.sources.tables import ShopData

TRAIN_ASOF = "2024-01-25"
TEST_ASOF = "2024-01-30"
SEVERAL_DAYS = ["2024-01-23", "2024-01-24", "2024-01-25"]
SMOKE_DIR = "/root/testdata/sf0.001"


def _data(spark: SparkSession, sf_dir: str) -> ShopData:
    # the session's spark.checkpoint.dir is used as is; where none is set, tables
    # go below the configured warehouse
    ensure_checkpoint_dir(spark)
    return ShopData(spark, sf_dir)


# ---------------------------------------------------------------------------
# flagship: role x item mall features (Q1) and its parts
# ---------------------------------------------------------------------------

def q_role_item_features(spark, sf_dir):
    from cartwise.plans.role_item import role_item_features
    d = _data(spark, sf_dir)
    return role_item_features(d.click_log(), d.buy_log(), d.role_profile(TEST_ASOF), TEST_ASOF, day_num=30)


def q_click_scan_range(spark, sf_dir):
    from cartwise.operators.daily import click_scan
    return click_scan(_data(spark, sf_dir).click_log(), TRAIN_ASOF, 7)


def q_click_explode(spark, sf_dir):
    from cartwise.operators.daily import clicked_items
    return clicked_items(_data(spark, sf_dir).click_log())


def q_click_explode_tab(spark, sf_dir):
    from cartwise.operators.daily import click_scan, explode_clicks
    return explode_clicks(click_scan(_data(spark, sf_dir).click_log(), TRAIN_ASOF, 7))


def q_event_age(spark, sf_dir):
    from cartwise.functions.dates import age
    b = _data(spark, sf_dir).buy_log()
    return b.select("role_id", "item_id", "dt", age("dt", TEST_ASOF).alias("age"))


def q_daily_clicks(spark, sf_dir):
    from cartwise.operators.daily import daily_clicks
    return daily_clicks(_data(spark, sf_dir).click_log(), TEST_ASOF, 30)


def q_daily_buys(spark, sf_dir):
    from cartwise.operators.daily import daily_buys
    return daily_buys(_data(spark, sf_dir).buy_log(), TEST_ASOF, 30)


def q_active_days(spark, sf_dir):
    from cartwise.plans.role_item import pair_clicks
    p = pair_clicks(_data(spark, sf_dir).click_log(), TEST_ASOF, 30)
    return p.select("role_id", "item_id", "click_day_week", "click_day_month")


def q_rank_in_role(spark, sf_dir):
    from cartwise.plans.role_item import pair_clicks
    p = pair_clicks(_data(spark, sf_dir).click_log(), TEST_ASOF, 30)
    return p.select("role_id", "item_id", "click_num_week", "rn_click_week")


def q_role_opens(spark, sf_dir):
    from cartwise.plans.role_item import role_opens
    return role_opens(_data(spark, sf_dir).click_log(), TEST_ASOF, 30)


def q_guarded_ctr(spark, sf_dir):
    df = q_role_item_features(spark, sf_dir)
    return df.select("role_id", "item_id", *[c for c in df.columns if "_ctr_" in c])


def q_role_recency_gap(spark, sf_dir):
    df = q_role_item_features(spark, sf_dir)
    return df.select("role_id", "item_id", "final_buy_day", "role_final_day", "final_buy_gap")


# ---------------------------------------------------------------------------
# pair / role / item features (Q5-Q9), training and test sets (Q10, Q11)
# ---------------------------------------------------------------------------

def _logs(spark, sf_dir):
    from cartwise.operators.daily import clicked_items
    from cartwise.plans.training import Logs
    d = _data(spark, sf_dir)
    return Logs(clicks=clicked_items(d.click_log()), buys=d.buy_log(), active_roles=d.active_roles(),
                catalog=d.catalog(), role_daily=d.role_daily_features(), new_items=d.new_items())


def _asof(spark, sf_dir, asof):
    from cartwise.plans.training import features_as_of
    return features_as_of(_logs(spark, sf_dir), asof)


def q_positive_pairs(spark, sf_dir):
    from cartwise.plans.pair import positive_pairs
    return positive_pairs(_data(spark, sf_dir).buy_log(), TRAIN_ASOF)


def q_active_clicks(spark, sf_dir):
    from cartwise.functions.dates import shift
    from cartwise.operators.daily import before, restrict, roles_on
    lg = _logs(spark, sf_dir)
    return restrict(before(lg.clicks, TRAIN_ASOF), roles_on(lg.active_roles, shift(TRAIN_ASOF, -1)), lg.catalog)


def q_trailing_week_clicks(spark, sf_dir):
    from cartwise.operators.daily import band
    return band(_logs(spark, sf_dir).clicks, TRAIN_ASOF, 7)


def q_click_windows(spark, sf_dir):
    from cartwise.constants import PAIR_CLICK_WINDOWS
    from cartwise.operators.windows import windowed_sums
    f = _asof(spark, sf_dir, TRAIN_ASOF)
    return windowed_sums(f.click_hist, ["role_id", "item_id"], "cnt", PAIR_CLICK_WINDOWS, lambda n: f"cnt_{n}")


def q_buy_windows(spark, sf_dir):
    from cartwise.constants import PAIR_BUY_WINDOWS
    from cartwise.operators.windows import windowed_sums
    f = _asof(spark, sf_dir, TRAIN_ASOF)
    return windowed_sums(f.buy_hist, ["role_id", "item_id"], "buy_num", PAIR_BUY_WINDOWS,
                         lambda n: f"buy_num_{n}")


def q_recency(spark, sf_dir):
    f = _asof(spark, sf_dir, TRAIN_ASOF)
    return f.click_hist.groupBy("role_id", "item_id").agg(F.min("age").alias("d_dt_click_final"),
                                                          F.max("age").alias("d_dt_click_first"))


def q_pair_click_features(spark, sf_dir):
    return _asof(spark, sf_dir, TRAIN_ASOF).pair_clicks


def q_pair_buy_features(spark, sf_dir):
    return _asof(spark, sf_dir, TRAIN_ASOF).pair_buys


def q_window_share(spark, sf_dir):
    p = q_pair_click_features(spark, sf_dir)
    return p.select("role_id", "item_id", *[c for c in p.columns if c.endswith("_ctr")])


def q_global_dense_rank(spark, sf_dir):
    p = q_pair_click_features(spark, sf_dir)
    return p.select("role_id", "item_id", *[c for c in p.columns if c.startswith("click_rank_")])


def q_click_flags(spark, sf_dir):
    p = q_pair_click_features(spark, sf_dir)
    return p.select("role_id", "item_id", "d_dt_click_final",
                    *[c for c in p.columns if c.startswith("is_click_dt_")])


def q_have_buy_flags(spark, sf_dir):
    p = q_pair_buy_features(spark, sf_dir)
    return p.select("role_id", "item_id", *[c for c in p.columns if c.startswith("have_buy_")])


def q_role_windows(spark, sf_dir):
    r = _asof(spark, sf_dir, TRAIN_ASOF).roles
    return r.select("role_id", *[c for c in r.columns if c.endswith("_user")])


def q_item_windows(spark, sf_dir):
    it = _asof(spark, sf_dir, TRAIN_ASOF).items
    return it.select("item_id", *[c for c in it.columns if c.endswith("_item")])


def q_role_profile(spark, sf_dir):
    from cartwise.plans.pair import role_profile
    lg = _logs(spark, sf_dir)
    return role_profile(lg.role_daily, lg.active_roles, TRAIN_ASOF)


def q_item_is_new(spark, sf_dir):
    from cartwise.plans.pair import item_is_new
    lg = _logs(spark, sf_dir)
    return item_is_new(lg.catalog, lg.new_items, TRAIN_ASOF)


def q_new_items(spark, sf_dir):
    from cartwise.plans.pair import new_items
    return new_items(_data(spark, sf_dir).new_items(), TEST_ASOF)


def q_top_seller(spark, sf_dir):
    from cartwise.plans.pair import top_sellers
    lg = _logs(spark, sf_dir)
    return top_sellers(lg.buys, lg.active_roles, lg.catalog, TEST_ASOF)


def q_click_buy_outer(spark, sf_dir):
    from cartwise.plans.training import click_buy_outer
    f = _asof(spark, sf_dir, TRAIN_ASOF)
    return click_buy_outer(f.pair_clicks, f.pair_buys)


def q_label_pairs(spark, sf_dir):
    from cartwise.plans.training import click_buy_outer, label_pairs
    lg = _logs(spark, sf_dir)
    from cartwise.plans.training import features_as_of
    f = features_as_of(lg, TRAIN_ASOF)
    return label_pairs(click_buy_outer(f.pair_clicks, f.pair_buys), lg.buys, TRAIN_ASOF) \
        .select("role_id", "item_id", "label")


def q_training_rows(spark, sf_dir):
    from cartwise.plans.training import training_rows
    return training_rows(_logs(spark, sf_dir), TRAIN_ASOF)


def q_test_rows(spark, sf_dir):
    from cartwise.plans.training import test_rows
    return test_rows(_logs(spark, sf_dir), TEST_ASOF)


def q_train_counts(spark, sf_dir):
    from cartwise.plans.training import train_counts
    return train_counts(q_training_rows(spark, sf_dir))


def q_dedupe_pairs(spark, sf_dir):
    from cartwise.operators.daily import before
    return before(_logs(spark, sf_dir).clicks, TEST_ASOF).dropDuplicates(["role_id", "item_id"]) \
        .select("role_id", "item_id")


# ---------------------------------------------------------------------------
# ranking and evaluation (Q12, Q15) with the deterministic stand-in score
# ---------------------------------------------------------------------------

def _evaluation(spark, sf_dir, asof=TEST_ASOF, logs=None, features=None):
    from cartwise.plans.pair import top_sellers
    from cartwise.plans.recommend import (candidate_features, candidate_grid, day_purchases, heuristic_score,
                                          previous_buys)
    from cartwise.plans.training import AsOf, click_buy_outer, day_buyers
    lg = logs if logs is not None else _logs(spark, sf_dir)
    f = AsOf(lg, asof, features)
    grid = candidate_grid(day_buyers(lg.buys, lg.active_roles, asof), lg.catalog, lg.catalog_rows())
    pairs = click_buy_outer(f.pair_clicks, f.pair_buys)
    cand = candidate_features(grid, f, pairs)
    return dict(logs=lg, f=f, grid=grid, pairs=pairs, cand=cand, scored=heuristic_score(cand),
                top=top_sellers(lg.buys, lg.active_roles, lg.catalog, asof),
                bought=previous_buys(lg.buys, lg.catalog, asof),
                purchases=day_purchases(lg.buys, lg.active_roles, asof))


def _evaluated(e, scored, seen=lambda df: df):
    """hit@k and revenue@k of ``scored`` from lists of the largest k; ``seen`` maps the tables' items."""
    from cartwise.constants import HIT_KS
    from cartwise.plans.recommend import hit_revenue_from_top, recommend_list
    ranked = recommend_list(scored, e["top"], e["bought"], limit=max(HIT_KS))
    return hit_revenue_from_top(seen(ranked), seen(e["purchases"]), seen(e["logs"].catalog), seen(e["top"]),
                                seen(e["bought"]))


def q_candidate_grid(spark, sf_dir):
    return _evaluation(spark, sf_dir)["grid"]


def q_candidate_features(spark, sf_dir):
    return _evaluation(spark, sf_dir)["cand"]


def q_candidate_prune(spark, sf_dir):
    from cartwise.plans.recommend import candidate_prune
    e = _evaluation(spark, sf_dir)
    return candidate_prune(e["grid"], e["top"], e["bought"])


def q_rank_candidates(spark, sf_dir):
    from cartwise.operators.ranking import rank_in_group
    s = _evaluation(spark, sf_dir)["scored"]
    return rank_in_group(s, "role_id", "score", "position", zero_based=True).select(
        "role_id", "item_id", "score", "position")


def q_recommend_list(spark, sf_dir):
    from cartwise.plans.recommend import recommend_list
    e = _evaluation(spark, sf_dir)
    return recommend_list(e["scored"], e["top"], e["bought"])


def q_default_filled_rank(spark, sf_dir):
    from cartwise.plans.recommend import default_filled_rank, heuristic_score
    from cartwise.plans.training import test_rows
    e = _evaluation(spark, sf_dir)
    return default_filled_rank(e["grid"], heuristic_score(test_rows(e["logs"], TEST_ASOF)))


def q_hit_revenue_at_k(spark, sf_dir):
    e = _evaluation(spark, sf_dir)
    out = _evaluated(e, e["scored"])
    return out.select(*[F.round(c, 2).alias(c) if c.startswith("revenue_") else F.col(c) for c in out.columns])


# ---------------------------------------------------------------------------
# early feature variant (Q2-Q4); factorisation inputs, popularity, correlation;
# catalog, attribute text, smoothing
# ---------------------------------------------------------------------------

def q_masked_daily(spark, sf_dir):
    from cartwise.constants import MASKED_WINDOWS
    from cartwise.operators.windows import masked_daily
    return masked_daily(_asof(spark, sf_dir, TRAIN_ASOF).click_hist, "cnt", MASKED_WINDOWS)


def q_daily_click_features(spark, sf_dir):
    from cartwise.plans.early import daily_click_features
    return daily_click_features(_asof(spark, sf_dir, TRAIN_ASOF).click_hist)


def q_daily_buy_features(spark, sf_dir):
    from cartwise.plans.early import daily_buy_features
    return daily_buy_features(_asof(spark, sf_dir, TRAIN_ASOF).buy_hist)


def q_global_min_rank(spark, sf_dir):
    return q_daily_click_features(spark, sf_dir).select("role_id", "item_id", "cnt_week", "rank_week")


def q_cross_features(spark, sf_dir):
    from cartwise.plans.early import cross_features, daily_buy_features, daily_click_features
    f = _asof(spark, sf_dir, TRAIN_ASOF)
    return cross_features(daily_click_features(f.click_hist), daily_buy_features(f.buy_hist))


def q_interaction_weight(spark, sf_dir):
    from cartwise.plans.factorize import interactions
    return interactions(_logs(spark, sf_dir).clicks, TRAIN_ASOF)


def q_dense_ids(spark, sf_dir):
    from cartwise.plans.factorize import dense_ids, interactions
    return dense_ids(interactions(_logs(spark, sf_dir).clicks, TRAIN_ASOF))


def _mf_catalog(spark, sf_dir):
    """All items less the factorisation blacklist (the rank blacklist does not apply)."""
    from cartwise.constants import MF_CATALOG_BLACKLIST
    return _data(spark, sf_dir).catalog(blacklist=MF_CATALOG_BLACKLIST)


def q_popularity(spark, sf_dir):
    from cartwise.operators.metrics import popularity
    from cartwise.plans.factorize import interactions
    lg = _logs(spark, sf_dir)
    return popularity(interactions(lg.clicks, TRAIN_ASOF), _mf_catalog(spark, sf_dir))


def q_item_correlation(spark, sf_dir):
    from cartwise.operators.metrics import item_correlation
    from cartwise.constants import TOP_SELLER_N
    from cartwise.operators.ranking import top_items
    from cartwise.plans.factorize import interactions
    from cartwise.session import materialize
    rows = materialize(interactions(_logs(spark, sf_dir).clicks, TEST_ASOF))
    # the top items of the interactions themselves: never one that their blacklist removed
    return item_correlation(rows, top_items(rows, "num", TOP_SELLER_N), _mf_catalog(spark, sf_dir))


def q_order_item_correlation(spark, sf_dir):
    """A15 over the larger buy log (lineitem x orders): quantity correlation of the
    best-selling part with every part, over customers buying both."""
    from cartwise.operators.metrics import item_correlation
    from cartwise.operators.ranking import top_items
    from cartwise.session import materialize
    buys = _data(spark, sf_dir).order_buys()
    # role x item quantities (A18), written once: the top seller and the
    # correlation both read them, so lineitem x orders is joined once
    totals = materialize(buys.groupBy("role_id", "item_id").agg(F.sum("buy_num").cast("bigint").alias("q")))
    top = top_items(totals, "q", 1).select("item_id")
    return item_correlation(totals, top, None, value="q", pre_aggregated=True)


def q_stream_daily_clicks(spark, sf_dir):
    """The click log written as files, run through the Structured Streaming day
    counts (A1) until caught up: every day, the open ones included."""
    from cartwise.sources.files import scratch_path
    from cartwise.streaming.daily import (click_log_stream, daily_click_counts, latest_counts, start_daily_counts)
    src = scratch_path(spark, "click-log-stream-src")
    _data(spark, sf_dir).click_log().write.parquet(src)
    sink, ckpt = scratch_path(spark, "daily-clicks-sink"), scratch_path(spark, "daily-clicks-ckpt")
    start_daily_counts(daily_click_counts(click_log_stream(spark, src)), sink, ckpt).awaitTermination()
    return latest_counts(spark, sink)


def q_item_catalog(spark, sf_dir):
    return _data(spark, sf_dir).catalog()


def q_avatar_attributes(spark, sf_dir):
    from cartwise.constants import AVATAR_KEYS
    from cartwise.functions.payload import extract_attributes
    return extract_attributes(_data(spark, sf_dir).avatar_log(), "wear", keys=AVATAR_KEYS + ("k",))


def q_smoothed_ctr(spark, sf_dir):
    from cartwise.constants import SMOOTH_START
    from cartwise.operators.smoothing import smoothed_ctr
    return smoothed_ctr(_data(spark, sf_dir).ctr_counts(), *SMOOTH_START)


# ---------------------------------------------------------------------------
# rows-only queries: learned models, factor vectors, file sources
# ---------------------------------------------------------------------------

MODEL_TRAIN_DAYS = ["2024-01-20", "2024-01-21", "2024-01-22", "2024-01-23", "2024-01-24", "2024-01-25"]


def _factors(spark, sf_dir, asof):
    from cartwise.plans.factorize import fit_factors, interactions
    return fit_factors(interactions(_logs(spark, sf_dir).clicks, asof))


def q_als_factors(spark, sf_dir):
    fs = _factors(spark, sf_dir, TRAIN_ASOF)
    return (fs.roles.select(F.lit("role").alias("entity"), F.col("role_id").alias("id"), "features")
            .unionByName(fs.items.select(F.lit("item").alias("entity"), F.col("item_id").alias("id"), "features")))


def q_embedding_features(spark, sf_dir):
    from cartwise.plans.factorize import embedding_features
    fs = _factors(spark, sf_dir, TRAIN_ASOF)
    roles = _asof(spark, sf_dir, TRAIN_ASOF).roles
    return embedding_features(roles, fs.roles, "role_id", "user_fm")


def q_training_rows_mf(spark, sf_dir):
    """Q10 rows with the factorisation columns (vectors fitted on the week before)."""
    from cartwise.plans.factorize import with_factor_features
    return with_factor_features(q_training_rows(spark, sf_dir), _factors(spark, sf_dir, TRAIN_ASOF))


def q_pair_score(spark, sf_dir):
    from cartwise.plans.factorize import pair_score
    from cartwise.plans.training import test_rows
    return pair_score(test_rows(_logs(spark, sf_dir), TEST_ASOF), _factors(spark, sf_dir, TEST_ASOF))


def q_recommend_fallback(spark, sf_dir):
    from cartwise.plans.factorize import recommend_fallback
    from cartwise.plans.training import day_buyers
    lg = _logs(spark, sf_dir)
    return recommend_fallback(day_buyers(lg.buys, lg.active_roles, TEST_ASOF), _factors(spark, sf_dir, TEST_ASOF),
                              _mf_catalog(spark, sf_dir))


def q_mf_hit_at_k(spark, sf_dir):
    """hit@k / revenue@k of the factorisation recommender with popularity fallback:
    every buyer and purchase of the day, no item skipped."""
    from cartwise.operators.daily import on_day
    from cartwise.plans.factorize import fallback_positions
    from cartwise.plans.recommend import hit_revenue_at_k
    purchases = on_day(_logs(spark, sf_dir).buys, TEST_ASOF)
    ranked = fallback_positions(purchases, _factors(spark, sf_dir, TEST_ASOF), _mf_catalog(spark, sf_dir))
    return hit_revenue_at_k(ranked, purchases, blacklist=())


def _ranking_factors(spark, sf_dir, asof):
    from cartwise.plans.factorize import interactions
    from cartwise.plans.ranking_loss import fit_ranking
    return fit_ranking(interactions(_logs(spark, sf_dir).clicks, asof))


def q_ranking_factors(spark, sf_dir):
    """Vectors of the ranking-loss factorisation (the last feature is the bias)."""
    fs = _ranking_factors(spark, sf_dir, TRAIN_ASOF)
    return (fs.roles.select(F.lit("role").alias("entity"), F.col("role_id").alias("id"), "features")
            .unionByName(fs.items.select(F.lit("item").alias("entity"), F.col("item_id").alias("id"), "features")))


def q_ranking_hit_at_k(spark, sf_dir):
    """``mf_hit_at_k`` with the vectors of the ranking loss."""
    from cartwise.operators.daily import on_day
    from cartwise.plans.factorize import fallback_positions
    from cartwise.plans.recommend import hit_revenue_at_k
    purchases = on_day(_logs(spark, sf_dir).buys, TEST_ASOF)
    ranked = fallback_positions(purchases, _ranking_factors(spark, sf_dir, TEST_ASOF), _mf_catalog(spark, sf_dir))
    return hit_revenue_at_k(ranked, purchases, blacklist=())


def q_mf_top_lists(spark, sf_dir):
    """The 25 best items of every buyer of the test day, without the buyers x items grid."""
    from cartwise.plans.top_products import recommend_top
    from cartwise.plans.training import day_buyers
    lg = _logs(spark, sf_dir)
    buyers = day_buyers(lg.buys, lg.active_roles, TEST_ASOF)
    return recommend_top(buyers, _factors(spark, sf_dir, TEST_ASOF), _mf_catalog(spark, sf_dir))[0]


def q_fm_mixed(spark, sf_dir):
    """Factorisation machine over both ids and every numeric feature of the training rows."""
    from cartwise.plans.fm import fit_fm
    from cartwise.plans.models import feature_columns
    rows = q_training_rows(spark, sf_dir)
    return fit_fm(rows, numeric=feature_columns(rows), sweeps=1).rows.select("role_id", "item_id", "label", "score")


def q_holdout_split(spark, sf_dir):
    from cartwise.plans.models import holdout_split
    return holdout_split(q_training_rows(spark, sf_dir)).select("role_id", "item_id", "asof", "label", "is_val")


def _learned(spark, sf_dir, days, factors):
    """Train on ``days``, persist and reload the model, score the test day's candidates.
    The training days and the test day are one keyed feature plan; with ``factors``
    both sides carry the factorisation columns of their own as-of day."""
    from cartwise.functions.dates import to_day
    from cartwise.plans.factorize import factor_features_days
    from cartwise.plans import boosting
    from cartwise.plans.models import score, train_gbt
    from cartwise.plans.target_rate import item_rates, with_item_rate
    from cartwise.plans.training import Features, training_rows_from
    from cartwise.session import materialize
    from cartwise.sources.files import scratch_path
    lg = _logs(spark, sf_dir).written()
    feats = Features(lg, days + [TEST_ASOF])
    e = _evaluation(spark, sf_dir, TEST_ASOF, logs=lg, features=feats)
    rows, cand = training_rows_from(feats, lg.buys, days), e["cand"]
    rows, cand = materialize(rows), cand.withColumn("asof", F.lit(to_day(TEST_ASOF)))
    rates = materialize(item_rates(rows, lg.catalog_table(), [TEST_ASOF]))
    rows, cand = with_item_rate(rows, rates), with_item_rate(cand, rates)
    if factors:
        rows, cand = factor_features_days(rows, lg.clicks, days), factor_features_days(cand, lg.clicks, [TEST_ASOF])
    cand = cand.drop("asof")
    model, _ = train_gbt(rows)
    model = boosting.load(spark, boosting.save(model, spark, scratch_path(spark, "gbt-model")))
    return e, score(model, cand)


def q_gbt_score(spark, sf_dir):
    """Boosted trees over six as-of days rank the catalog for the test day's buyers."""
    from cartwise.plans.recommend import recommend_list
    e, scored = _learned(spark, sf_dir, MODEL_TRAIN_DAYS, False)
    return recommend_list(scored, e["top"], e["bought"])


def q_gbt_hit_revenue_at_k(spark, sf_dir):
    """The main path whole: features and factorisation columns, boosted trees, ranked
    list, hit@k and revenue@k of the test day."""
    e, scored = _learned(spark, sf_dir, SEVERAL_DAYS, True)
    return _evaluated(e, scored)


def q_test_rows_mf(spark, sf_dir):
    """Q11 rows with the factorisation columns (vectors fitted on the week before)."""
    from cartwise.plans.factorize import with_factor_features
    return with_factor_features(q_test_rows(spark, sf_dir), _factors(spark, sf_dir, TEST_ASOF))


def q_test_rows_unseen(spark, sf_dir):
    """Q11 rows and whether their pair has no vector (score -2)."""
    from cartwise.constants import UNSEEN_PAIR_SCORE
    rows = q_pair_score(spark, sf_dir)
    return rows.withColumn("unseen", F.col("fm") == UNSEEN_PAIR_SCORE).drop("fm")


def q_item_onehot(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    from cartwise.plans.models import item_onehot
    hot = item_onehot(_data(spark, sf_dir).catalog()).withColumn("a", vector_to_array("item_id_vec"))
    at = F.array_position("a", F.lit(1.0)).cast("int")
    # the encoder keeps one more slot for values it has not seen
    return hot.select("item_id", (F.size("a") - 1).alias("size"), (at - 1).alias("hot_index"),
                      F.element_at("a", at).alias("hot_value"))


def q_fm_classify(spark, sf_dir):
    from cartwise.plans.models import fm_classify
    return fm_classify(q_training_rows(spark, sf_dir), numeric=("cnt_21", "buy_num_21"))


def q_beta_binomial_fit(spark, sf_dir):
    from cartwise.operators.smoothing import fit_prior, prior_frame
    return prior_frame(spark, fit_prior(_data(spark, sf_dir).ctr_counts()))


def q_scan_delimited(spark, sf_dir):
    """Write the click log as headerless TSV, scan it back with supplied names and types."""
    from cartwise.sources.files import read_delimited, scratch_path, write_delimited
    path = write_delimited(_data(spark, sf_dir).click_log(), scratch_path(spark, "click-log-tsv"))
    return read_delimited(spark, path, ["role_id", "child_tab", "item_list", "dt"],
                          {"role_id": "bigint", "dt": "date"})


def q_scan_sidecar_schema(spark, sf_dir):
    """Role daily features as TSV plus a names file with five trailing extras."""
    from cartwise.sources.files import read_with_sidecar, scratch_path, write_delimited
    feats = _data(spark, sf_dir).role_daily_features()
    data = write_delimited(feats, scratch_path(spark, "role-features-tsv"))
    extra = ["src_a", "src_b", "src_c", "src_d", "src_e"]
    names = spark.createDataFrame([(n,) for n in feats.columns + extra], "value string").coalesce(1)
    names_path = scratch_path(spark, "role-features-names")
    names.write.mode("overwrite").text(names_path)
    return read_with_sidecar(spark, data, names_path, 5, types={"role_id": "bigint", "dt": "date",
                                                                "c_acctbal": "double", "c_nationkey": "bigint"})


def q_split_by_day(spark, sf_dir):
    """Role daily features written partitioned by day; every day read back on its own
    (pruned): its rows and a sum of its roles."""
    from functools import reduce

    from cartwise.sources.files import read_day, scratch_path, write_by_day
    feats = _data(spark, sf_dir).role_daily_features()
    path = write_by_day(feats, scratch_path(spark, "role-features-by-day"))
    days = sorted(r["dt"] for r in spark.read.parquet(path).select("dt").distinct().collect())  # one per day
    parts = [read_day(spark, path, d).groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"),
                                                        F.sum("role_id").cast("bigint").alias("role_sum")) for d in days]
    return reduce(DataFrame.unionByName, parts)


def q_training_rows_days(spark, sf_dir):
    """Q10 over several training days in one plan."""
    from cartwise.plans.training import training_rows
    return training_rows(_logs(spark, sf_dir), SEVERAL_DAYS)


def q_training_rows_rate(spark, sf_dir):
    """Q10 rows of several days with the item's rate on strictly earlier as-of days."""
    from cartwise.plans.target_rate import item_rates, with_item_rate
    from cartwise.session import materialize
    rows = materialize(q_training_rows_days(spark, sf_dir))
    return with_item_rate(rows, item_rates(rows))


def q_item_rate_test_day(spark, sf_dir):
    """The same rate of every catalog item for the test day, from all training days."""
    from cartwise.functions.dates import to_day
    from cartwise.plans.target_rate import item_rates
    rates = item_rates(q_training_rows_days(spark, sf_dir), _data(spark, sf_dir).catalog(), [TEST_ASOF])
    return rates.where(F.col("asof") == F.lit(to_day(TEST_ASOF)))


def _stores(spark, sf_dir):
    """The exploded clicks and the purchases as two day stores."""
    import uuid

    from cartwise.sources.day_store import DayStore
    from cartwise.sources.files import scratch_path
    lg = _logs(spark, sf_dir)
    out = []
    for name, rows in (("clicks", lg.clicks.select("role_id", "item_id", "cnt", "dt")),
                       ("buys", lg.buys.select("role_id", "item_id", "buy_num", "dt"))):
        store = DayStore(spark, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"store-{name}"))
        out.append(store.create(rows).load(rows))
    return out


def q_day_store_totals(spark, sf_dir):
    """Clicks and purchases of each role, from two day stores joined on the role; the day
    before the as-of day is loaded a second time."""
    from cartwise.functions.dates import shift, to_day
    clicks, buys = _stores(spark, sf_dir)
    again = _logs(spark, sf_dir).clicks.where(F.col("dt") == F.lit(to_day(shift(TRAIN_ASOF, -1))))
    clicks.load(again)
    return clicks.totals("cnt", "n_clicks").join(buys.totals("buy_num", "n_buys"), "role_id")


def q_day_bitmaps(spark, sf_dir):
    """Active days and recency of each pair from day bitmaps: those of the day before, moved
    by a day, and the last day's clicks."""
    from cartwise.functions.dates import shift, to_day
    from cartwise.operators import day_bits as B
    keys, days, last = ["role_id", "item_id"], 90, shift(TRAIN_ASOF, -1)
    clicks = _logs(spark, sf_dir).clicks
    old = B.day_words(clicks.withColumn("age", F.datediff(F.lit(last), "dt")).where("age >= 1"), keys, days)
    new = B.day_words(clicks.where(F.col("dt") == F.lit(to_day(last))).withColumn("age", F.lit(1)), keys, days)
    both = B.merged(old.select(*keys, B.shifted(F.col("days"), 1, days).alias("days")).unionByName(new), keys, days)
    w = F.col("days")
    return both.select(*keys, B.active_in(w, 7).alias("click_day_week"), B.active_in(w, 30).alias("click_day_month"),
                       B.last_age(w, days).alias("d_dt_click_final"), B.first_age(w, days).alias("d_dt_click_first"))


def q_scan_indexed_csv(spark, sf_dir):
    """The exploded clicks saved as CSV with a row index, read back without it."""
    from cartwise.operators.daily import clicked_items
    from cartwise.sources.files import read_indexed_csv, scratch_path, write_delimited
    rows = clicked_items(_data(spark, sf_dir).click_log()).select("role_id", "item_id", "dt", "cnt")
    path = write_delimited(rows.select(F.monotonically_increasing_id().alias("_i"), "*"),
                           scratch_path(spark, "clicks-indexed"), sep=",", header=True)
    return read_indexed_csv(spark, path, ["role_id", "item_id", "dt", "cnt"],
                            {"role_id": "bigint", "item_id": "bigint", "dt": "date", "cnt": "bigint"})


def q_scan_catalog(spark, sf_dir):
    """S3: the catalog as a one-column file, read back."""
    from cartwise.sources.files import read_catalog, scratch_path, write_delimited
    return read_catalog(spark, write_delimited(_data(spark, sf_dir).catalog(), scratch_path(spark, "catalog")))


# ---------------------------------------------------------------------------
# branches that the tables as they are do not reach, over rows derived from them
# ---------------------------------------------------------------------------

#: Moves the item ids (0 to 99) onto the rank blacklist.
ITEM_SHIFT = 940


def q_avatar_text(spark, sf_dir):
    """Every event's attributes as the five-key literal text, or as ``[]``."""
    from cartwise.functions.payload import extract_attributes
    from cartwise.sources.tables import item_of
    log = _data(spark, sf_dir).avatar_log()
    k = item_of("wear").cast("string")
    text = F.concat(F.lit("{u'Gender': u'"), F.when(F.col("role_id") % 2 == 0, "m").otherwise("f"), F.lit("', 'Tshirt': "), k,
                    F.lit("L, u'Pants': None, 'Hat': '"), k, F.lit("', 'Hair': u'h"), k, F.lit("'}"))
    return extract_attributes(log.withColumn("wear", F.when(F.col("role_id") % 5 == 0, "[]").otherwise(text)))


def q_click_scan_odd(spark, sf_dir):
    """empty payloads and records of another screen among the click log."""
    from cartwise.operators.daily import click_scan
    log = _data(spark, sf_dir).click_log()
    log = log.withColumns({"item_list": F.when(F.col("role_id") % 7 == 0, "{}").otherwise(F.col("item_list")),
                           "child_tab": F.when(F.col("role_id") % 5 == 0, "UIOther").otherwise(F.col("child_tab"))})
    return click_scan(log, TRAIN_ASOF, 7)


def q_item_catalog_shifted(spark, sf_dir):
    """the catalog of shifted ids, some of which the rank blacklist removes."""
    d = _data(spark, sf_dir)
    return d.catalog(items=d.items().select((F.col("item_id") + ITEM_SHIFT).alias("item_id")))


def q_day_slugs(spark, sf_dir):
    """Clicks per day under the ``MMdd`` slugs of the day and of the day before."""
    from cartwise.functions.dates import day_slug
    return (_logs(spark, sf_dir).clicks.groupBy(day_slug("dt").alias("slug"), day_slug("dt", 1).alias("slug_before"))
            .agg(F.sum("cnt").cast("bigint").alias("n_clicks")))


def q_interaction_weight_solo(spark, sf_dir):
    """Items made rare (one id per role and item), so that single rows reach
    their item's total."""
    from cartwise.plans.factorize import interactions
    clicks = _logs(spark, sf_dir).clicks
    return interactions(clicks.withColumn("item_id", F.col("role_id") * 100 + F.col("item_id")), TRAIN_ASOF)


def q_hit_revenue_skipped(spark, sf_dir):
    """List and purchases of shifted ids, some purchases blacklisted."""
    e = _evaluation(spark, sf_dir)
    out = _evaluated(e, e["scored"], lambda df: df.withColumn("item_id", F.col("item_id") + ITEM_SHIFT))
    return out.select(*[F.round(c, 2).alias(c) if c.startswith("revenue_") else F.col(c) for c in out.columns])


def q_recommend_unseen_roles(spark, sf_dir):
    """M7: vectors fitted without every third role; those get the popularity order."""
    from cartwise.plans.factorize import fit_factors, interactions, recommend_fallback
    from cartwise.plans.training import day_buyers
    lg = _logs(spark, sf_dir)
    fs = fit_factors(interactions(lg.clicks.where(F.col("role_id") % 3 != 0), TEST_ASOF))
    ranked = recommend_fallback(day_buyers(lg.buys, lg.active_roles, TEST_ASOF), fs, _mf_catalog(spark, sf_dir))
    return ranked.where("source = 'popular'").drop("source")


def entry(spark: SparkSession) -> DataFrame:
    return q_role_item_features(spark, SMOKE_DIR)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "role_item_features": q_role_item_features,
    "click_scan_range": q_click_scan_range,
    "click_explode": q_click_explode,
    "click_explode_tab": q_click_explode_tab,
    "event_age": q_event_age,
    "daily_clicks": q_daily_clicks,
    "daily_buys": q_daily_buys,
    "active_days": q_active_days,
    "rank_in_role": q_rank_in_role,
    "role_opens": q_role_opens,
    "guarded_ctr": q_guarded_ctr,
    "role_recency_gap": q_role_recency_gap,
    "positive_pairs": q_positive_pairs,
    "active_clicks": q_active_clicks,
    "trailing_week_clicks": q_trailing_week_clicks,
    "click_windows": q_click_windows,
    "buy_windows": q_buy_windows,
    "recency": q_recency,
    "pair_click_features": q_pair_click_features,
    "pair_buy_features": q_pair_buy_features,
    "window_share": q_window_share,
    "global_dense_rank": q_global_dense_rank,
    "click_flags": q_click_flags,
    "have_buy_flags": q_have_buy_flags,
    "role_windows": q_role_windows,
    "item_windows": q_item_windows,
    "role_profile": q_role_profile,
    "item_is_new": q_item_is_new,
    "new_items": q_new_items,
    "top_seller": q_top_seller,
    "click_buy_outer": q_click_buy_outer,
    "label_pairs": q_label_pairs,
    "training_rows": q_training_rows,
    "test_rows": q_test_rows,
    "train_counts": q_train_counts,
    "dedupe_pairs": q_dedupe_pairs,
    "candidate_grid": q_candidate_grid,
    "candidate_features": q_candidate_features,
    "candidate_prune": q_candidate_prune,
    "rank_candidates": q_rank_candidates,
    "recommend_list": q_recommend_list,
    "default_filled_rank": q_default_filled_rank,
    "hit_revenue_at_k": q_hit_revenue_at_k,
    "masked_daily": q_masked_daily,
    "daily_click_features": q_daily_click_features,
    "daily_buy_features": q_daily_buy_features,
    "global_min_rank": q_global_min_rank,
    "cross_features": q_cross_features,
    "interaction_weight": q_interaction_weight,
    "dense_ids": q_dense_ids,
    "popularity": q_popularity,
    "item_correlation": q_item_correlation,
    "order_item_correlation": q_order_item_correlation,
    "stream_daily_clicks": q_stream_daily_clicks,
    "item_catalog": q_item_catalog,
    "avatar_attributes": q_avatar_attributes,
    "smoothed_ctr": q_smoothed_ctr,
    "als_factors": q_als_factors,
    "embedding_features": q_embedding_features,
    "pair_score": q_pair_score,
    "training_rows_mf": q_training_rows_mf,
    "recommend_fallback": q_recommend_fallback,
    "mf_hit_at_k": q_mf_hit_at_k,
    "holdout_split": q_holdout_split,
    "gbt_score": q_gbt_score,
    "item_onehot": q_item_onehot,
    "fm_classify": q_fm_classify,
    "beta_binomial_fit": q_beta_binomial_fit,
    "scan_delimited": q_scan_delimited,
    "scan_sidecar_schema": q_scan_sidecar_schema,
    "split_by_day": q_split_by_day,
    "training_rows_days": q_training_rows_days,
    "training_rows_rate": q_training_rows_rate,
    "day_store_totals": q_day_store_totals,
    "day_bitmaps": q_day_bitmaps,
    "item_rate_test_day": q_item_rate_test_day,
    "scan_indexed_csv": q_scan_indexed_csv,
    "scan_catalog": q_scan_catalog,
    "ranking_factors": q_ranking_factors,
    "ranking_hit_at_k": q_ranking_hit_at_k,
    "mf_top_lists": q_mf_top_lists,
    "fm_mixed": q_fm_mixed,
    "gbt_hit_revenue_at_k": q_gbt_hit_revenue_at_k,
    "test_rows_mf": q_test_rows_mf,
    "test_rows_unseen": q_test_rows_unseen,
    "avatar_text": q_avatar_text,
    "click_scan_odd": q_click_scan_odd,
    "item_catalog_shifted": q_item_catalog_shifted,
    "day_slugs": q_day_slugs,
    "interaction_weight_solo": q_interaction_weight_solo,
    "hit_revenue_skipped": q_hit_revenue_skipped,
    "recommend_unseen_roles": q_recommend_unseen_roles,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **(_llm.QUERIES if _llm else {})}


# ---------------------------------------------------------------------------
# DuckDB oracle. The logical inputs are rebuilt directly from events (no
# payload text round trip), so the oracle also checks the text encode/decode.
# ---------------------------------------------------------------------------

TRAIN = "DATE '2024-01-25'"
TEST = "DATE '2024-01-30'"

BASE = r"""
ev AS (
  SELECT event_id, user_id AS role_id, event_type, value, props, CAST(ts AS DATE) AS dt,
         CAST(regexp_extract(props, '"k"\s*:\s*(-?\d+)', 1) AS BIGINT) AS item_id
  FROM events),
ce AS (
  SELECT role_id, CASE event_type WHEN 'click' THEN 'UIMallCloth' WHEN 'view' THEN 'UIMall'
                  ELSE 'UIDtsAppearanceMall' END AS child_tab, dt, item_id
  FROM ev WHERE event_type IN ('click', 'view', 'signup')),
clog AS (
  SELECT role_id, child_tab, dt, item_id, CAST(count(*) AS BIGINT) AS cnt
  FROM ce GROUP BY role_id, child_tab, dt, item_id),
crec AS (
  SELECT role_id, child_tab, dt,
         '{' || string_agg(CAST(item_id AS VARCHAR) || ':' || CAST(cnt AS VARCHAR), ',' ORDER BY item_id) || '}'
           AS item_list
  FROM clog GROUP BY role_id, child_tab, dt),
buys AS (
  SELECT role_id, item_id, CAST(1 AS BIGINT) AS buy_num, value AS price, 'MallCloth' AS mall_type, dt
  FROM ev WHERE event_type = 'purchase'),
active AS (SELECT DISTINCT role_id, dt FROM ev),
catalog AS (
  SELECT DISTINCT item_id FROM ev
  WHERE item_id IS NOT NULL AND item_id NOT IN (978, 988, 989, 990, 991, 992, 993, 994, 995))
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip()] + [c.strip() for c in ctes if c.strip()]) + "\n"


def _ri_ctes(asof: str, start: str) -> list[str]:
    """CTEs of the role x item feature table over [start, asof]."""
    return [f"""
dc AS (
  SELECT role_id, item_id, ({asof} - dt) AS age, CAST(sum(cnt) AS BIGINT) AS cnd,
         CAST(sum(CASE WHEN child_tab <> 'UIDtsAppearanceMall' THEN 1 ELSE 0 END) AS BIGINT) AS cdd
  FROM clog WHERE dt BETWEEN {start} AND {asof}
  GROUP BY role_id, item_id, ({asof} - dt))""", """
pc AS (
  SELECT role_id, item_id,
    CAST(sum(CASE WHEN age <= 1 THEN cnd ELSE 0 END) AS BIGINT) AS click_num_day,
    CAST(sum(CASE WHEN age <= 3 THEN cnd ELSE 0 END) AS BIGINT) AS click_num_day3,
    CAST(sum(CASE WHEN age <= 7 THEN cnd ELSE 0 END) AS BIGINT) AS click_num_week,
    CAST(sum(cnd) AS BIGINT) AS click_num_month,
    CAST(sum(CASE WHEN age <= 1 THEN cdd ELSE 0 END) AS BIGINT) AS click_num_dis_day,
    CAST(sum(CASE WHEN age <= 3 THEN cdd ELSE 0 END) AS BIGINT) AS click_num_dis_day3,
    CAST(sum(CASE WHEN age <= 7 THEN cdd ELSE 0 END) AS BIGINT) AS click_num_dis_week,
    CAST(sum(cdd) AS BIGINT) AS click_num_dis_month,
    CAST(count(DISTINCT age) AS BIGINT) AS click_day_month,
    CAST(count(DISTINCT CASE WHEN age <= 7 THEN age END) AS BIGINT) AS click_day_week,
    CAST(min(age) AS BIGINT) AS final_click_day
  FROM dc GROUP BY role_id, item_id)""", """
pcr AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY role_id ORDER BY click_num_week DESC, item_id) AS BIGINT)
         AS rn_click_week FROM pc)""", f"""
db AS (
  SELECT role_id, item_id, ({asof} - dt) AS age, CAST(count(*) AS BIGINT) AS bnd
  FROM buys WHERE dt BETWEEN {start} AND {asof}
    AND mall_type IN ('MallCloth', 'MallGiftBag', 'AppearanceMallHot')
  GROUP BY role_id, item_id, ({asof} - dt))""", """
pb AS (
  SELECT role_id, item_id,
    CAST(sum(CASE WHEN age <= 1 THEN bnd ELSE 0 END) AS BIGINT) AS buy_num_day,
    CAST(sum(CASE WHEN age <= 3 THEN bnd ELSE 0 END) AS BIGINT) AS buy_num_day3,
    CAST(sum(CASE WHEN age <= 7 THEN bnd ELSE 0 END) AS BIGINT) AS buy_num_week,
    CAST(sum(bnd) AS BIGINT) AS buy_num_month,
    CAST(count(DISTINCT age) AS BIGINT) AS buy_day_month,
    CAST(count(DISTINCT CASE WHEN age <= 7 THEN age END) AS BIGINT) AS buy_day_week,
    CAST(min(age) AS BIGINT) AS final_buy_day
  FROM db GROUP BY role_id, item_id)""", """
pbr AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY role_id ORDER BY buy_num_week DESC, item_id) AS BIGINT)
         AS rn_buy_week FROM pb)""", f"""
online AS (
  SELECT role_id, CAST({asof} - max(dt) AS BIGINT) AS role_final_day
  FROM ev WHERE dt <= {asof} GROUP BY role_id)""", f"""
dop AS (
  SELECT role_id, child_tab, ({asof} - dt) AS age, CAST(count(*) AS BIGINT) AS n
  FROM crec WHERE dt BETWEEN {start} AND {asof} AND item_list <> '{{}}'
    AND child_tab IN ('UIMallCloth', 'UIMall')
  GROUP BY role_id, child_tab, ({asof} - dt))""", """
ro AS (
  SELECT role_id,
    CAST(sum(CASE WHEN child_tab = 'UIMallCloth' AND age < 1 THEN n ELSE 0 END) AS BIGINT) AS UIMallCloth_day,
    CAST(sum(CASE WHEN child_tab = 'UIMallCloth' AND age < 3 THEN n ELSE 0 END) AS BIGINT) AS UIMallCloth_day3,
    CAST(sum(CASE WHEN child_tab = 'UIMallCloth' AND age < 7 THEN n ELSE 0 END) AS BIGINT) AS UIMallCloth_week,
    CAST(sum(CASE WHEN child_tab = 'UIMallCloth' THEN n ELSE 0 END) AS BIGINT) AS UIMallCloth_month,
    CAST(sum(CASE WHEN child_tab = 'UIMall' AND age < 1 THEN n ELSE 0 END) AS BIGINT) AS UIMall_day,
    CAST(sum(CASE WHEN child_tab = 'UIMall' AND age < 3 THEN n ELSE 0 END) AS BIGINT) AS UIMall_day3,
    CAST(sum(CASE WHEN child_tab = 'UIMall' AND age < 7 THEN n ELSE 0 END) AS BIGINT) AS UIMall_week,
    CAST(sum(CASE WHEN child_tab = 'UIMall' THEN n ELSE 0 END) AS BIGINT) AS UIMall_month
  FROM dop GROUP BY role_id)""", """
ri AS (
  SELECT c.role_id, c.item_id,
    coalesce(b.buy_num_day, -1) AS buy_num_day, coalesce(b.buy_num_day3, -1) AS buy_num_day3,
    coalesce(b.buy_num_week, -1) AS buy_num_week, coalesce(b.buy_num_month, -1) AS buy_num_month,
    coalesce(b.buy_day_week, -1) AS buy_day_week, coalesce(b.buy_day_month, -1) AS buy_day_month,
    coalesce(c.final_click_day, 100) AS final_click_day,
    c.click_num_day, c.click_num_day3, c.click_num_week, c.click_num_month,
    c.click_day_week, c.click_day_month,
    c.click_num_dis_day, c.click_num_dis_day3, c.click_num_dis_week, c.click_num_dis_month,
    c.rn_click_week, coalesce(b.rn_buy_week, -1) AS rn_buy_week,
    coalesce(b.final_buy_day, 100) AS final_buy_day,
    coalesce(o.role_final_day - b.final_buy_day, -1) AS final_buy_gap,
    o.role_final_day,
    coalesce(r.UIMallCloth_day, 0) AS UIMallCloth_day, coalesce(r.UIMallCloth_day3, 0) AS UIMallCloth_day3,
    coalesce(r.UIMallCloth_week, 0) AS UIMallCloth_week, coalesce(r.UIMallCloth_month, 0) AS UIMallCloth_month,
    coalesce(r.UIMall_day, 0) AS UIMall_day, coalesce(r.UIMall_day3, 0) AS UIMall_day3,
    coalesce(r.UIMall_week, 0) AS UIMall_week, coalesce(r.UIMall_month, 0) AS UIMall_month,
    CASE WHEN r.UIMallCloth_day IS NULL OR r.UIMallCloth_day < 5 THEN 0.0
         ELSE c.click_num_dis_day / r.UIMallCloth_day END AS UIMallCloth_ctr_day,
    CASE WHEN r.UIMallCloth_day3 IS NULL OR r.UIMallCloth_day3 < 5 THEN 0.0
         ELSE c.click_num_dis_day3 / r.UIMallCloth_day3 END AS UIMallCloth_ctr_day3,
    CASE WHEN r.UIMallCloth_week IS NULL OR r.UIMallCloth_week < 5 THEN 0.0
         ELSE c.click_num_dis_week / r.UIMallCloth_week END AS UIMallCloth_ctr_week,
    CASE WHEN r.UIMallCloth_month IS NULL OR r.UIMallCloth_month < 5 THEN 0.0
         ELSE c.click_num_dis_month / r.UIMallCloth_month END AS UIMallCloth_ctr_month,
    CASE WHEN r.UIMall_day IS NULL OR r.UIMall_day < 3 THEN 0.0
         ELSE c.click_num_dis_day / r.UIMall_day END AS UIMall_ctr_day,
    CASE WHEN r.UIMall_day3 IS NULL OR r.UIMall_day3 < 4 THEN 0.0
         ELSE c.click_num_dis_day3 / r.UIMall_day3 END AS UIMall_ctr_day3,
    CASE WHEN r.UIMall_week IS NULL OR r.UIMall_week < 6 THEN 0.0
         ELSE c.click_num_dis_week / r.UIMall_week END AS UIMall_ctr_week,
    CASE WHEN r.UIMall_month IS NULL OR r.UIMall_month < 10 THEN 0.0
         ELSE c.click_num_dis_month / r.UIMall_month END AS UIMall_ctr_month
  FROM pcr c
  LEFT JOIN pbr b ON b.role_id = c.role_id AND b.item_id = c.item_id
  LEFT JOIN online o ON o.role_id = c.role_id
  LEFT JOIN ro r ON r.role_id = c.role_id)"""]


def _sum_if(val: str, cond: str, alias: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN {val} ELSE 0 END) AS BIGINT) AS {alias}"


CLICK_W = (1, 3, 7, 14, 21)
BUY_W = (1, 3, 7, 21)
ROLE_CW, ROLE_BW = (1, 3, 7), (1, 3, 7, 14, 21)
ITEM_CW, ITEM_BW = (1, 3, 7, 21), (1, 3, 7, 14, 21)
PCF_COLS = ([f"cnt_{n}" for n in CLICK_W] + ["d_dt_click_final", "d_dt_click_first"]
            + [f"cnt_{n}_ctr" for n in CLICK_W] + [f"click_rank_{n}" for n in CLICK_W]
            + [f"is_click_dt_{n}" for n in (1, 3, 7)])
PBF_COLS = ([f"buy_num_{n}" for n in BUY_W] + ["d_dt_buy_final"] + [f"buy_num_{n}_ctr" for n in BUY_W]
            + [f"have_buy_{n}" for n in BUY_W])


def _pair_ctes(a: str) -> list[str]:
    """CTEs of the pair / role / item features as of day ``a`` (a DATE literal)."""
    prev = f"({a} - 1)"
    ctes = [f"""
act AS (SELECT DISTINCT role_id FROM active WHERE dt = {prev})""", f"""
ch AS (
  SELECT role_id, item_id, CAST({a} - dt AS BIGINT) AS age, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM clog WHERE dt < {a} AND role_id IN (SELECT role_id FROM act) AND item_id IN (SELECT item_id FROM catalog)
  GROUP BY role_id, item_id, {a} - dt)""", f"""
bh AS (
  SELECT role_id, item_id, CAST({a} - dt AS BIGINT) AS age, CAST(sum(buy_num) AS BIGINT) AS buy_num
  FROM buys WHERE dt < {a} AND role_id IN (SELECT role_id FROM act) AND item_id IN (SELECT item_id FROM catalog)
  GROUP BY role_id, item_id, {a} - dt)"""]
    cw = ", ".join(_sum_if("cnt", f"age <= {n}", f"cnt_{n}") for n in CLICK_W)
    ctes.append(f"""
pcf0 AS (SELECT role_id, item_id, {cw}, min(age) AS d_dt_click_final, max(age) AS d_dt_click_first
         FROM ch GROUP BY role_id, item_id)""")
    ctes.append("cn AS (SELECT " + ", ".join(
        f"CAST(count(*) FILTER (WHERE age <= {n}) AS BIGINT) AS n{n}" for n in CLICK_W) + " FROM ch)")
    share = ", ".join(f"coalesce(p.cnt_{n} / nullif(cn.n{n}, 0), 0.0) AS cnt_{n}_ctr" for n in CLICK_W)
    rank = ", ".join(f"CAST(dense_rank() OVER (ORDER BY p.cnt_{n} DESC) AS BIGINT) AS click_rank_{n}"
                     for n in CLICK_W)
    flags = ", ".join(f"CAST(CASE WHEN p.d_dt_click_final <= {n} THEN 1 ELSE 0 END AS BIGINT) AS is_click_dt_{n}"
                      for n in (1, 3, 7))
    ctes.append(f"pcf AS (SELECT p.*, {share}, {rank}, {flags} FROM pcf0 p CROSS JOIN cn)")
    bw = ", ".join(_sum_if("buy_num", f"age <= {n}", f"buy_num_{n}") for n in BUY_W)
    ctes.append(f"pbf0 AS (SELECT role_id, item_id, {bw}, min(age) AS d_dt_buy_final FROM bh GROUP BY role_id, item_id)")
    ctes.append("bn AS (SELECT " + ", ".join(
        f"CAST(count(*) FILTER (WHERE age <= {n}) AS BIGINT) AS n{n}" for n in BUY_W) + " FROM bh)")
    bshare = ", ".join(f"coalesce(p.buy_num_{n} / nullif(bn.n{n}, 0), 0.0) AS buy_num_{n}_ctr" for n in BUY_W)
    bflags = ", ".join(f"CAST(CASE WHEN p.buy_num_{n} > 0 THEN 1 ELSE 0 END AS BIGINT) AS have_buy_{n}" for n in BUY_W)
    ctes.append(f"pbf AS (SELECT p.*, {bshare}, {bflags} FROM pbf0 p CROSS JOIN bn)")
    # role grain
    ctes.append(f"""
prof AS (
  SELECT a.role_id, c.c_acctbal, CAST(c.c_nationkey AS BIGINT) AS c_nationkey, c.c_mktsegment
  FROM act a JOIN customer c ON c.c_custkey = a.role_id)""")
    ctes.append("rcw AS (SELECT role_id, " + ", ".join(
        _sum_if("cnt", f"age <= {n}", f"cnt_{n}_user") for n in ROLE_CW) + " FROM ch GROUP BY role_id)")
    ctes.append("rbw AS (SELECT role_id, " + ", ".join(
        _sum_if("buy_num", f"age <= {n}", f"buy_num_{n}_user") for n in ROLE_BW) + " FROM bh GROUP BY role_id)")
    rcols = ", ".join([f"coalesce(rcw.cnt_{n}_user, 0) AS cnt_{n}_user" for n in ROLE_CW]
                      + [f"coalesce(rbw.buy_num_{n}_user, 0) AS buy_num_{n}_user" for n in ROLE_BW])
    ctes.append(f"rf AS (SELECT prof.*, {rcols} FROM prof LEFT JOIN rcw USING (role_id) LEFT JOIN rbw USING (role_id))")
    # item grain
    ctes.append(f"""
nit AS (
  SELECT item_id, 'item_' || CAST(item_id AS VARCHAR) AS item_name,
         CAST(DATE '2024-01-01' + CAST(item_id % 30 AS INTEGER) AS DATE) AS newdt
  FROM (SELECT DISTINCT item_id FROM ev WHERE item_id IS NOT NULL))""")
    ctes.append(f"""
itf AS (
  SELECT c.item_id, CAST(CASE WHEN n.item_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS is_new
  FROM catalog c LEFT JOIN (SELECT DISTINCT item_id FROM nit WHERE newdt > {a} - 14 AND newdt < {a} - 7) n
  USING (item_id))""")
    ctes.append("icw AS (SELECT item_id, " + ", ".join(
        _sum_if("cnt", f"age <= {n}", f"cnt_{n}_item") for n in ITEM_CW) + " FROM ch GROUP BY item_id)")
    ctes.append("ibw AS (SELECT item_id, " + ", ".join(
        _sum_if("buy_num", f"age <= {n}", f"buy_num_{n}_item") for n in ITEM_BW) + " FROM bh GROUP BY item_id)")
    icols = ", ".join([f"coalesce(icw.cnt_{n}_item, 0) AS cnt_{n}_item" for n in ITEM_CW]
                      + [f"coalesce(ibw.buy_num_{n}_item, 0) AS buy_num_{n}_item" for n in ITEM_BW])
    ctes.append(f"itemf AS (SELECT itf.*, {icols} FROM itf LEFT JOIN icw USING (item_id) LEFT JOIN ibw USING (item_id))")
    # outer join of click and buy pair features, label, assembly
    ocols = ", ".join([f"coalesce(c.{x}, 0) AS {x}" for x in PCF_COLS] + [f"coalesce(b.{x}, 0) AS {x}" for x in PBF_COLS])
    ctes.append(f"""
cbo AS (
  SELECT coalesce(c.role_id, b.role_id) AS role_id, coalesce(c.item_id, b.item_id) AS item_id, {ocols}
  FROM pcf c FULL JOIN pbf b ON b.role_id = c.role_id AND b.item_id = c.item_id)""")
    ctes.append(f"pos AS (SELECT DISTINCT item_id, role_id FROM buys WHERE dt = {a})")
    ctes.append("""
lab AS (
  SELECT o.*, CAST(CASE WHEN p.role_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label
  FROM cbo o LEFT JOIN pos p ON p.role_id = o.role_id AND p.item_id = o.item_id
  WHERE o.role_id IN (SELECT role_id FROM pos))""")
    ctes.append(f"""
trn AS (
  SELECT lab.*, rf.* EXCLUDE (role_id), itemf.* EXCLUDE (item_id), {a} AS asof
  FROM lab JOIN rf USING (role_id) JOIN itemf USING (item_id))""")
    ctes.append(f"""
tst AS (
  SELECT cbo.*, rf.* EXCLUDE (role_id), itemf.* EXCLUDE (item_id), {a} AS asof
  FROM cbo JOIN rf USING (role_id) JOIN itemf USING (item_id)
  WHERE cbo.role_id IN (SELECT role_id FROM buys WHERE dt = {a})
    AND cbo.role_id IN (SELECT role_id FROM act))""")
    return ctes


P_TRAIN = _pair_ctes(TRAIN)
P_TEST = _pair_ctes(TEST)


HIT_K = (1, 3, 5, 10, 15, 20, 25)
BLACK = "978, 988, 989, 990, 991, 992, 993, 994, 995"


def _eval_ctes(a: str, item: str = "item_id") -> list[str]:
    pairs = ", ".join(f"coalesce(o.{x}, 0) AS {x}" for x in PCF_COLS + PBF_COLS)
    ctes = _pair_ctes(a) + [f"""
buyers AS (SELECT DISTINCT role_id FROM buys WHERE dt = {a} AND role_id IN (SELECT role_id FROM act))""", """
grid AS (SELECT b.role_id, c.item_id FROM buyers b CROSS JOIN catalog c)""", f"""
cand AS (
  SELECT g.role_id, g.item_id, rf.* EXCLUDE (role_id), itemf.* EXCLUDE (item_id), {pairs}
  FROM grid g LEFT JOIN rf ON rf.role_id = g.role_id LEFT JOIN itemf ON itemf.item_id = g.item_id
  LEFT JOIN cbo o ON o.role_id = g.role_id AND o.item_id = g.item_id)""", """
scored AS (
  SELECT *, CAST((cnt_7 * 3 + cnt_21 + buy_num_21 * 2) * 1000 + coalesce(buy_num_21_item, 0) AS DOUBLE) AS score
  FROM cand)""", f"""
top AS (
  SELECT item_id, CAST(sum(buy_num) AS BIGINT) AS buy_num FROM buys
  WHERE dt > {a} - 4 AND dt < {a} AND role_id IN (SELECT role_id FROM act)
    AND item_id IN (SELECT item_id FROM catalog)
  GROUP BY item_id ORDER BY buy_num DESC, item_id LIMIT 1)""", """
topr AS (SELECT item_id, row_number() OVER (ORDER BY buy_num DESC, item_id) AS sr FROM top)""", f"""
prevb AS (SELECT DISTINCT role_id, item_id FROM buys WHERE dt < {a} AND item_id IN (SELECT item_id FROM catalog))""", """
kept AS (
  SELECT s.role_id, s.item_id, s.score, t.sr FROM scored s LEFT JOIN topr t ON t.item_id = s.item_id
  LEFT JOIN prevb p ON p.role_id = s.role_id AND p.item_id = s.item_id
  WHERE t.sr IS NOT NULL OR p.role_id IS NULL)""", """
ranked AS (
  SELECT role_id, item_id, score,
         CAST(row_number() OVER (PARTITION BY role_id ORDER BY sr ASC NULLS LAST, score DESC, item_id) - 1 AS BIGINT)
           AS position
  FROM kept)""", f"""
purch AS (SELECT role_id, item_id, price FROM buys WHERE dt = {a} AND role_id IN (SELECT role_id FROM act))"""]
    hits = []
    for k in HIT_K:
        cond = f"{item} NOT IN ({BLACK}) AND position IS NOT NULL AND position < {k}"
        hits.append(f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS hit_{k}")
        hits.append(f"round(sum(CASE WHEN {cond} THEN price ELSE 0.0 END), 2) AS revenue_{k}")
    hits.append(f"CAST(sum(CASE WHEN {item} NOT IN ({BLACK}) AND position IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS total")
    hits.append(f"CAST(sum(CASE WHEN {item} NOT IN ({BLACK}) AND position IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missed")
    hits.append(f"CAST(sum(CASE WHEN {item} IN ({BLACK}) THEN 1 ELSE 0 END) AS BIGINT) AS skipped")
    ctes.append("hr0 AS (SELECT " + ", ".join(hits) +
                " FROM purch p LEFT JOIN ranked r USING (role_id, item_id))")
    rates = ", ".join(f"CAST(hit_{k} AS DOUBLE) * 100.0 / nullif(total, 0) AS hit_rate_{k}" for k in HIT_K)
    ctes.append(f"hr AS (SELECT *, {rates} FROM hr0)")
    return ctes


E_TEST = _eval_ctes(TEST)


MASK = ((1, "1"), (3, "3"), (7, "week"), (30, "month"))
MF_BLACK = "1, 10000, 9, 9001, 9019, 1020, 1018, 1014, 0, 2, 45"
MF_CAT = ("SELECT DISTINCT item_id FROM ev WHERE item_id IS NOT NULL "
          "AND item_id NOT IN (991, 992, 993, 994, 995)")


def _early_ctes() -> list[str]:
    cm = ", ".join(f"CAST(CASE WHEN age <= {n} THEN cnt ELSE 0 END AS BIGINT) AS cnt_{nm}" for n, nm in MASK)
    bm = ", ".join(f"CAST(CASE WHEN age <= {n} THEN buy_num ELSE 0 END AS BIGINT) AS buy_num_{nm}" for n, nm in MASK)
    return [f"md AS (SELECT role_id, item_id, age, cnt, {cm} FROM ch)", """
dcf0 AS (SELECT *, min(age) OVER (PARTITION BY role_id, item_id) AS d_dt_final_click FROM md)""", """
dcf AS (
  SELECT role_id, item_id, cnt, cnt_1, cnt_3, cnt_week, cnt_month, d_dt_final_click,
    CAST(CASE WHEN d_dt_final_click <= 1 THEN 1 ELSE 0 END AS BIGINT) AS final_click_dt_1,
    CAST(CASE WHEN d_dt_final_click <= 3 THEN 1 ELSE 0 END AS BIGINT) AS final_click_dt_3,
    CAST(CASE WHEN d_dt_final_click <= 7 THEN 1 ELSE 0 END AS BIGINT) AS final_click_dt_week,
    CAST(rank() OVER (ORDER BY cnt_week DESC) AS BIGINT) AS rank_week
  FROM dcf0)""", f"mb AS (SELECT role_id, item_id, age, buy_num, {bm} FROM bh)", """
dbf0 AS (SELECT *, min(age) OVER (PARTITION BY role_id, item_id) AS d_dt_buy_final FROM mb)""", """
dbf AS (
  SELECT role_id, item_id, buy_num, buy_num_1, buy_num_3, buy_num_week, buy_num_month, d_dt_buy_final,
    CAST(CASE WHEN d_dt_buy_final <= 1 THEN 1 ELSE 0 END AS BIGINT) AS final_buy_dt_1,
    CAST(CASE WHEN d_dt_buy_final <= 3 THEN 1 ELSE 0 END AS BIGINT) AS final_buy_dt_3,
    CAST(rank() OVER (ORDER BY buy_num_week DESC) AS BIGINT) AS buy_rank_week
  FROM dbf0)""", """
xc AS (
  SELECT role_id, item_id, CAST(sum(cnt) AS BIGINT) AS cnt, CAST(sum(cnt_1) AS BIGINT) AS cnt_1,
    CAST(sum(cnt_3) AS BIGINT) AS cnt_3, CAST(sum(cnt_week) AS BIGINT) AS cnt_week,
    CAST(sum(cnt_month) AS BIGINT) AS cnt_month, min(d_dt_final_click) AS d_dt_final_click,
    min(final_click_dt_1) AS final_click_dt_1, min(final_click_dt_3) AS final_click_dt_3,
    min(final_click_dt_week) AS final_click_dt_week, min(rank_week) AS rank_week
  FROM dcf GROUP BY role_id, item_id)""", """
xb AS (
  SELECT role_id, item_id, CAST(sum(buy_num) AS BIGINT) AS buy_num, CAST(sum(buy_num_1) AS BIGINT) AS buy_num_1,
    CAST(sum(buy_num_3) AS BIGINT) AS buy_num_3, CAST(sum(buy_num_week) AS BIGINT) AS buy_num_week,
    CAST(sum(buy_num_month) AS BIGINT) AS buy_num_month, min(d_dt_buy_final) AS d_dt_buy_final,
    min(final_buy_dt_1) AS final_buy_dt_1, min(final_buy_dt_3) AS final_buy_dt_3,
    min(buy_rank_week) AS buy_rank_week
  FROM dbf GROUP BY role_id, item_id)""", """
xf AS (
  SELECT c.*, coalesce(b.buy_num, 0) AS buy_num, coalesce(b.buy_num_1, 0) AS buy_num_1,
    coalesce(b.buy_num_3, 0) AS buy_num_3, coalesce(b.buy_num_week, 0) AS buy_num_week,
    coalesce(b.buy_num_month, 0) AS buy_num_month, coalesce(b.d_dt_buy_final, 0) AS d_dt_buy_final,
    coalesce(b.final_buy_dt_1, 0) AS final_buy_dt_1, coalesce(b.final_buy_dt_3, 0) AS final_buy_dt_3,
    coalesce(b.buy_rank_week, 0) AS buy_rank_week,
    coalesce(CAST(b.d_dt_buy_final AS DOUBLE) / nullif(CAST(c.d_dt_final_click AS DOUBLE), 0), 0.0) AS ctr,
    CAST(CASE WHEN b.d_dt_buy_final IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label
  FROM xc c LEFT JOIN xb b ON b.role_id = c.role_id AND b.item_id = c.item_id)"""]


def _mf_ctes(a: str) -> list[str]:
    return [f"""
mfi0 AS (SELECT role_id, item_id, dt, cnt AS num FROM clog
         WHERE dt > {a} - 8 AND dt < {a} AND item_id NOT IN ({MF_BLACK}))""", """
mfi AS (
  SELECT m.role_id, m.item_id, m.dt, m.num, CAST(CASE WHEN m.num >= t.tot THEN 1 ELSE 0 END AS BIGINT) AS num_s
  FROM mfi0 m JOIN (SELECT item_id, sum(num) AS tot FROM mfi0 GROUP BY item_id) t ON t.item_id = m.item_id)"""]


def _corr_sql() -> str:
    d = "CAST({} AS DOUBLE)"
    n, sx, sy, sxy, sxx, syy = (d.format(x) for x in ("n", "sx", "sy", "sxy", "sxx", "syy"))
    den = f"sqrt(({n} * {sxx} - {sx} * {sx}) * ({n} * {syy} - {sy} * {sy}))"
    return _with(*_mf_ctes(TEST)) + f"""
, top AS (SELECT item_id FROM mfi GROUP BY item_id ORDER BY sum(num) DESC, item_id LIMIT 1), tot AS (SELECT role_id, item_id, CAST(sum(num) AS BIGINT) AS q FROM mfi GROUP BY role_id, item_id),
xa AS (SELECT role_id, item_id AS item1, q AS x FROM tot WHERE item_id IN (SELECT item_id FROM top)),
xb2 AS (SELECT role_id, item_id AS item2, q AS y FROM tot WHERE item_id IN ({MF_CAT})),
s AS (SELECT item1, item2, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy, sum(x * x) AS sxx,
             sum(y * y) AS syy FROM xa JOIN xb2 USING (role_id) GROUP BY item1, item2)
SELECT item1, item2, CAST(n AS BIGINT) AS n_roles,
       CASE WHEN {den} > 0 THEN ({n} * {sxy} - {sx} * {sy}) / {den} END AS corr
FROM s"""



def _order_corr_sql() -> str:
    d = "CAST({} AS DOUBLE)"
    n, sx, sy, sxy, sxx, syy = (d.format(x) for x in ("n", "sx", "sy", "sxy", "sxx", "syy"))
    den = f"sqrt(({n} * {sxx} - {sx} * {sx}) * ({n} * {syy} - {sy} * {sy}))"
    return f"""
WITH ob AS (
  SELECT o.o_custkey AS role_id, l.l_partkey AS item_id, CAST(l.l_quantity AS BIGINT) AS q
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
top AS (SELECT item_id FROM ob GROUP BY item_id ORDER BY sum(q) DESC, item_id LIMIT 1),
tot AS (SELECT role_id, item_id, CAST(sum(q) AS BIGINT) AS q FROM ob GROUP BY role_id, item_id),
xa AS (SELECT role_id, item_id AS item1, q AS x FROM tot WHERE item_id IN (SELECT item_id FROM top)),
xb AS (SELECT role_id, item_id AS item2, q AS y FROM tot),
s AS (SELECT item1, item2, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy, sum(x * x) AS sxx,
             sum(y * y) AS syy FROM xa JOIN xb USING (role_id) GROUP BY item1, item2)
SELECT item1, item2, CAST(n AS BIGINT) AS n_roles,
       CASE WHEN {den} > 0 THEN ({n} * {sxy} - {sx} * {sy}) / {den} END AS corr
FROM s"""


RI_TEST = _ri_ctes(TEST, "DATE '2024-01-01'")

_DAYS_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({_with(*_pair_ctes(f"DATE '{d}'"))}SELECT * FROM trn)" for d in SEVERAL_DAYS)

_SQL: dict[str, str] = {
    "role_item_features": _with(*RI_TEST) + "SELECT * FROM ri",
    "guarded_ctr": _with(*RI_TEST) + """
SELECT role_id, item_id, UIMallCloth_ctr_day, UIMallCloth_ctr_day3, UIMallCloth_ctr_week, UIMallCloth_ctr_month,
       UIMall_ctr_day, UIMall_ctr_day3, UIMall_ctr_week, UIMall_ctr_month FROM ri""",
    "role_recency_gap": _with(*RI_TEST) + """
SELECT role_id, item_id, final_buy_day, role_final_day, final_buy_gap FROM ri""",
    "active_days": _with(*RI_TEST) + "SELECT role_id, item_id, click_day_week, click_day_month FROM pc",
    "rank_in_role": _with(*RI_TEST) + "SELECT role_id, item_id, click_num_week, rn_click_week FROM pcr",
    "role_opens": _with(*RI_TEST) + "SELECT * FROM ro",
    "daily_clicks": _with(*RI_TEST) + """
SELECT role_id, item_id, CAST(age AS BIGINT) AS age, cnd AS click_num_day, cdd AS click_num_dis_day FROM dc""",
    "daily_buys": _with(*RI_TEST) + """
SELECT role_id, item_id, CAST(age AS BIGINT) AS age, bnd AS buy_num_day FROM db""",
    "click_scan_range": _with() + f"""
SELECT role_id, child_tab, item_list, dt FROM crec
WHERE dt BETWEEN {TRAIN} - INTERVAL 6 DAY AND {TRAIN} AND item_list <> '{{}}'
  AND child_tab IN ('UIMallCloth', 'UIMall', 'UIDtsAppearanceMall')""",
    "click_explode": _with() + "SELECT role_id, item_id, dt, cnt FROM clog",
    "click_explode_tab": _with() + f"""
SELECT role_id, child_tab, dt, item_id, cnt FROM clog
WHERE dt BETWEEN {TRAIN} - INTERVAL 6 DAY AND {TRAIN}""",
    "event_age": _with() + f"SELECT role_id, item_id, dt, CAST({TEST} - dt AS BIGINT) AS age FROM buys",
    "positive_pairs": _with() + f"SELECT DISTINCT item_id, role_id FROM buys WHERE dt = {TRAIN}",
    "active_clicks": _with(*P_TRAIN) + f"""
SELECT role_id, item_id, dt, cnt FROM clog
WHERE dt < {TRAIN} AND role_id IN (SELECT role_id FROM act) AND item_id IN (SELECT item_id FROM catalog)""",
    "trailing_week_clicks": _with() + f"""
SELECT role_id, item_id, dt, cnt FROM clog WHERE dt > {TRAIN} - 8 AND dt < {TRAIN}""",
    "click_windows": _with(*P_TRAIN) + "SELECT role_id, item_id, " + ", ".join(
        f"cnt_{n}" for n in CLICK_W) + " FROM pcf0",
    "buy_windows": _with(*P_TRAIN) + "SELECT role_id, item_id, " + ", ".join(
        f"buy_num_{n}" for n in BUY_W) + " FROM pbf0",
    "recency": _with(*P_TRAIN) + "SELECT role_id, item_id, d_dt_click_final, d_dt_click_first FROM pcf0",
    "pair_click_features": _with(*P_TRAIN) + "SELECT * FROM pcf",
    "pair_buy_features": _with(*P_TRAIN) + "SELECT * FROM pbf",
    "window_share": _with(*P_TRAIN) + "SELECT role_id, item_id, " + ", ".join(
        f"cnt_{n}_ctr" for n in CLICK_W) + " FROM pcf",
    "global_dense_rank": _with(*P_TRAIN) + "SELECT role_id, item_id, " + ", ".join(
        f"click_rank_{n}" for n in CLICK_W) + " FROM pcf",
    "click_flags": _with(*P_TRAIN) + "SELECT role_id, item_id, d_dt_click_final, " + ", ".join(
        f"is_click_dt_{n}" for n in (1, 3, 7)) + " FROM pcf",
    "have_buy_flags": _with(*P_TRAIN) + "SELECT role_id, item_id, " + ", ".join(
        f"have_buy_{n}" for n in BUY_W) + " FROM pbf",
    "role_windows": _with(*P_TRAIN) + "SELECT * EXCLUDE (c_acctbal, c_nationkey, c_mktsegment) FROM rf",
    "item_windows": _with(*P_TRAIN) + "SELECT * EXCLUDE (is_new) FROM itemf",
    "role_profile": _with(*P_TRAIN) + "SELECT * FROM prof",
    "item_is_new": _with(*P_TRAIN) + "SELECT * FROM itf",
    "new_items": _with(*P_TEST) + f"SELECT item_id FROM nit WHERE newdt > {TEST} - 7",
    "top_seller": _with(*P_TEST) + f"""
SELECT item_id, CAST(sum(buy_num) AS BIGINT) AS buy_num FROM buys
WHERE dt > {TEST} - 4 AND dt < {TEST} AND role_id IN (SELECT role_id FROM act)
  AND item_id IN (SELECT item_id FROM catalog)
GROUP BY item_id ORDER BY buy_num DESC, item_id LIMIT 1""",
    "click_buy_outer": _with(*P_TRAIN) + "SELECT * FROM cbo",
    "label_pairs": _with(*P_TRAIN) + "SELECT role_id, item_id, label FROM lab",
    "training_rows": _with(*P_TRAIN) + "SELECT * FROM trn",
    "test_rows": _with(*P_TEST) + "SELECT * FROM tst",
    "train_counts": _with(*P_TRAIN) + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
       CAST(count(DISTINCT item_id) AS BIGINT) AS n_items FROM trn""",
    "dedupe_pairs": _with() + f"SELECT DISTINCT role_id, item_id FROM clog WHERE dt < {TEST}",
    "candidate_grid": _with(*E_TEST) + "SELECT * FROM grid",
    "candidate_features": _with(*E_TEST) + "SELECT * FROM cand",
    "candidate_prune": _with(*E_TEST) + """
SELECT g.role_id, g.item_id FROM grid g
WHERE g.item_id NOT IN (SELECT item_id FROM top)
  AND NOT EXISTS (SELECT 1 FROM prevb p WHERE p.role_id = g.role_id AND p.item_id = g.item_id)""",
    "rank_candidates": _with(*E_TEST) + """
SELECT role_id, item_id, score,
       CAST(row_number() OVER (PARTITION BY role_id ORDER BY score DESC, item_id) - 1 AS BIGINT) AS position
FROM scored""",
    "recommend_list": _with(*E_TEST) + "SELECT * FROM ranked",
    "default_filled_rank": _with(*E_TEST) + """
SELECT g.role_id, g.item_id, coalesce(t.score, 0.05::DOUBLE) AS score,
       CAST(row_number() OVER (PARTITION BY g.role_id ORDER BY coalesce(t.score, 0.05::DOUBLE) DESC, g.item_id) - 1
            AS BIGINT) AS position
FROM grid g LEFT JOIN (
  SELECT role_id, item_id,
         CAST((cnt_7 * 3 + cnt_21 + buy_num_21 * 2) * 1000 + coalesce(buy_num_21_item, 0) AS DOUBLE) AS score
  FROM tst) t ON t.role_id = g.role_id AND t.item_id = g.item_id""",
    "hit_revenue_at_k": _with(*E_TEST) + "SELECT * FROM hr",
    "masked_daily": _with(*P_TRAIN, *_early_ctes()) + "SELECT * FROM md",
    "daily_click_features": _with(*P_TRAIN, *_early_ctes()) + "SELECT * FROM dcf",
    "daily_buy_features": _with(*P_TRAIN, *_early_ctes()) + "SELECT * FROM dbf",
    "global_min_rank": _with(*P_TRAIN, *_early_ctes()) + "SELECT role_id, item_id, cnt_week, rank_week FROM dcf",
    "cross_features": _with(*P_TRAIN, *_early_ctes()) + "SELECT * FROM xf",
    "interaction_weight": _with(*_mf_ctes(TRAIN)) + "SELECT * FROM mfi",
    "dense_ids": _with(*_mf_ctes(TRAIN)) + """
SELECT *, CAST(dense_rank() OVER (ORDER BY role_id) - 1 AS INTEGER) AS role_id_index,
          CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_id_index FROM mfi""",
    "popularity": _with(*_mf_ctes(TRAIN)) + f"""
SELECT item_id, n, CAST(row_number() OVER (ORDER BY n DESC, item_id) - 1 AS BIGINT) AS position
FROM (SELECT item_id, CAST(count(*) AS BIGINT) AS n FROM mfi WHERE item_id IN ({MF_CAT}) GROUP BY item_id)""",
    "item_correlation": _corr_sql(),
    "order_item_correlation": _order_corr_sql(),
    "stream_daily_clicks": _with() + """
SELECT role_id, item_id, dt, CAST(sum(cnt) AS BIGINT) AS click_num_day,
       CAST(sum(CASE WHEN child_tab <> 'UIDtsAppearanceMall' THEN 1 ELSE 0 END) AS BIGINT) AS click_num_dis_day
FROM clog
GROUP BY role_id, item_id, dt""",
    "item_catalog": _with() + "SELECT item_id FROM catalog",
    "avatar_attributes": _with() + """
SELECT event_id, role_id, dt,
       json_extract_string(props, '$.Gender') AS gender, json_extract_string(props, '$.Tshirt') AS tshirt,
       json_extract_string(props, '$.Pants') AS pants, json_extract_string(props, '$.Hat') AS hat,
       json_extract_string(props, '$.Hair') AS hair, json_extract_string(props, '$.k') AS k
FROM ev""",
    "smoothed_ctr": _with() + """
SELECT item_id, CAST(count(*) AS DOUBLE) AS imps,
       CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) AS clks,
       (CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) + 1.0)
         / (CAST(count(*) AS DOUBLE) + 1.0 + 1.0) AS ctr
FROM ev WHERE event_type IN ('click', 'view') GROUP BY item_id""",
    "scan_delimited": _with() + "SELECT role_id, child_tab, item_list, dt FROM crec",
    "scan_sidecar_schema": _with() + """
SELECT a.role_id, a.dt, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment
FROM active a JOIN customer ON c_custkey = a.role_id""",
    "split_by_day": _with() + """
SELECT a.dt, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(a.role_id) AS BIGINT) AS role_sum
FROM active a JOIN customer ON c_custkey = a.role_id GROUP BY a.dt""",
    "training_rows_days": _DAYS_SQL,
    "day_store_totals": _with() + """
SELECT role_id, n_clicks, n_buys FROM (SELECT role_id, CAST(sum(cnt) AS BIGINT) AS n_clicks FROM clog GROUP BY role_id)
JOIN (SELECT role_id, CAST(sum(buy_num) AS BIGINT) AS n_buys FROM buys GROUP BY role_id) USING (role_id)""",
    "day_bitmaps": _with() + f"""
SELECT role_id, item_id, CAST(count(DISTINCT CASE WHEN age <= 7 THEN age END) AS BIGINT) AS click_day_week,
       CAST(count(DISTINCT CASE WHEN age <= 30 THEN age END) AS BIGINT) AS click_day_month,
       CAST(min(age) AS BIGINT) AS d_dt_click_final, CAST(max(age) AS BIGINT) AS d_dt_click_first
FROM (SELECT *, {TRAIN} - dt AS age FROM clog WHERE dt < {TRAIN} AND dt >= {TRAIN} - 90) GROUP BY role_id, item_id""",
    "training_rows_rate": f"""
WITH t AS ({_DAYS_SQL}), c AS (SELECT "asof", item_id, count(*) AS n, sum(label) AS p FROM t GROUP BY ALL),
     g AS (SELECT a."asof", sum(b.n) AS n, sum(b.p) AS p FROM (SELECT DISTINCT "asof" FROM c) a JOIN c b ON b."asof" < a."asof" GROUP BY a."asof"),
     o AS (SELECT a."asof", a.item_id, coalesce(sum(b.n), 0) AS n, coalesce(sum(b.p), 0) AS p
           FROM c a LEFT JOIN c b ON b."asof" < a."asof" AND b.item_id = a.item_id GROUP BY ALL)
SELECT t.*, coalesce((CAST(o.p AS DOUBLE) + {ITEM_RATE_PRIOR}.0 * (CAST(g.p AS DOUBLE) / CAST(g.n AS DOUBLE)))
                     / (CAST(o.n AS DOUBLE) + {ITEM_RATE_PRIOR}.0), 0.0) AS item_rate
FROM t JOIN o USING ("asof", item_id) LEFT JOIN g USING ("asof")""",
    "item_rate_test_day": f"""
WITH t AS ({_DAYS_SQL}), g AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS p FROM t),
     k AS ({_with()}SELECT item_id FROM catalog)
SELECT {TEST} AS asof, k.item_id, (CAST(coalesce(sum(label), 0) AS DOUBLE) + {ITEM_RATE_PRIOR}.0 * (max(g.p) / max(g.n)))
       / (CAST(count(t.item_id) AS DOUBLE) + {ITEM_RATE_PRIOR}.0) AS item_rate
FROM k CROSS JOIN g LEFT JOIN t USING (item_id) GROUP BY k.item_id""",
    "scan_indexed_csv": _with() + "SELECT role_id, item_id, dt, cnt FROM clog",
    "scan_catalog": _with() + "SELECT item_id FROM catalog",
    "test_rows_unseen": _with(*P_TEST, *_mf_ctes(TEST)) + """
SELECT *, role_id NOT IN (SELECT role_id FROM mfi) OR item_id NOT IN (SELECT item_id FROM mfi) AS unseen FROM tst""",
    "avatar_text": _with() + """
SELECT event_id, role_id, dt, CASE WHEN n THEN CASE WHEN role_id % 2 = 0 THEN 'm' ELSE 'f' END END AS gender,
       CASE WHEN n THEN CAST(item_id AS VARCHAR) END AS tshirt, CAST(NULL AS VARCHAR) AS pants,
       CASE WHEN n THEN CAST(item_id AS VARCHAR) END AS hat, CASE WHEN n THEN 'h' || item_id END AS hair
FROM (SELECT *, role_id % 5 <> 0 AS n FROM ev)""",
    "click_scan_odd": _with() + f"""
SELECT * FROM crec WHERE dt BETWEEN {TRAIN} - 6 AND {TRAIN} AND role_id % 7 <> 0 AND role_id % 5 <> 0""",
    "day_slugs": _with() + """
SELECT strftime(dt, '%m%d') AS slug, strftime(dt - 1, '%m%d') AS slug_before, CAST(sum(cnt) AS BIGINT) AS n_clicks
FROM clog GROUP BY dt""",
    "item_catalog_shifted": _with() + f"""
SELECT DISTINCT item_id + {ITEM_SHIFT} AS item_id FROM ev
WHERE item_id IS NOT NULL AND item_id + {ITEM_SHIFT} NOT IN ({BLACK})""",
    "interaction_weight_solo": _with("""
rare AS (SELECT role_id, role_id * 100 + item_id AS item_id, dt, cnt FROM clog)""",
                                     *[c.replace("FROM clog", "FROM rare") for c in _mf_ctes(TRAIN)]) + "SELECT * FROM mfi",
    "hit_revenue_skipped": _with(*_eval_ctes(TEST, f"item_id + {ITEM_SHIFT}")) + "SELECT * FROM hr",
    "recommend_unseen_roles": _with(*_eval_ctes(TEST), *[c.replace("FROM clog", "FROM (FROM clog WHERE role_id % 3 <> 0)")
                                                         for c in _mf_ctes(TEST)]) + f"""
SELECT role_id, item_id, CAST(n AS DOUBLE) AS score, position FROM buyers,
  (SELECT item_id, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, item_id) - 1 AS BIGINT) AS position
   FROM mfi WHERE item_id IN ({MF_CAT}) GROUP BY item_id)
WHERE role_id NOT IN (SELECT role_id FROM mfi)""",
    "item_onehot": _with() + """
SELECT item_id, CAST(count(*) OVER () AS INTEGER) AS size,
       CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS hot_index, CAST(1.0 AS DOUBLE) AS hot_value
FROM catalog""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each query with an oracle (rows-only queries are absent)."""
    return {**{k: v for k, v in _SQL.items() if k in _QUERIES}, **(_llm.ORACLE_SQL if _llm else {})}
