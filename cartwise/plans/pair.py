"""Pair, role and item features as of a day (Q5-Q9).

Inputs are the day-grain histories of ``operators.daily``: clicks / purchases
strictly before the as-of day, by roles active the day before, on catalog
items. Each feature grain is one conditional aggregate; global ranks use the
histogram ranker (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import (ITEM_BUY_WINDOWS, ITEM_CLICK_WINDOWS, NEW_ITEM_BAND, NEW_ITEM_RECENT_DAYS,
                                PAIR_BUY_WINDOWS, PAIR_CLICK_WINDOWS, RECENCY_FLAG_WINDOWS,
                                ROLE_BUY_WINDOWS, ROLE_CLICK_WINDOWS, TOP_SELLER_DAYS, TOP_SELLER_N)
from cartwise.functions.dates import day_in, shift, to_day
from cartwise.functions.exprs import flag
from cartwise.operators.daily import active_before, as_of_days, on_day, restrict, roles_on
from cartwise.operators.ranking import global_ranks, top_items
from cartwise.operators.windows import attach, windowed_sums, with_shares

PAIR = ["role_id", "item_id"]


def positive_pairs(buy_log: DataFrame, asof) -> DataFrame:
    """Distinct (item_id, role_id) bought on the as-of day."""
    return on_day(buy_log, asof).select("item_id", "role_id").distinct()


def pair_click_features(click_hist: DataFrame, windows=PAIR_CLICK_WINDOWS, keys=()) -> DataFrame:
    """One row per pair (per key, e.g. as-of day): ``cnt_N``, recency, shares
    ``cnt_N_ctr``, global dense ranks ``click_rank_N`` and recency flags
    ``is_click_dt_N`` (Q6 pair grain). Shares and ranks are taken within a key."""
    keys = list(keys)
    g = click_hist.groupBy(*keys, *PAIR).agg(
        *[F.sum(F.when(F.col("age") <= n, F.col("cnt")).otherwise(0)).cast("bigint").alias(f"cnt_{n}")
          for n in windows],
        F.min("age").alias("d_dt_click_final"), F.max("age").alias("d_dt_click_first"))
    g = with_shares(g, click_hist, windows, lambda n: f"cnt_{n}", lambda n: f"cnt_{n}_ctr", keys)
    g = global_ranks(g, {f"cnt_{n}": f"click_rank_{n}" for n in windows}, method="dense", bucketing="log2",
                     groups=keys)
    return g.withColumns({f"is_click_dt_{n}": flag(F.col("d_dt_click_final") <= n)
                          for n in RECENCY_FLAG_WINDOWS})


def pair_buy_features(buy_hist: DataFrame, windows=PAIR_BUY_WINDOWS, keys=()) -> DataFrame:
    """One row per pair (per key): ``buy_num_N``, shares, last-buy age, ``have_buy_N``
    (Q7 pair grain)."""
    keys = list(keys)
    g = buy_hist.groupBy(*keys, *PAIR).agg(
        *[F.sum(F.when(F.col("age") <= n, F.col("buy_num")).otherwise(0)).cast("bigint")
          .alias(f"buy_num_{n}") for n in windows],
        F.min("age").alias("d_dt_buy_final"))
    g = with_shares(g, buy_hist, windows, lambda n: f"buy_num_{n}", lambda n: f"buy_num_{n}_ctr", keys)
    return g.withColumns({f"have_buy_{n}": flag(F.col(f"buy_num_{n}") > 0) for n in windows})


def role_click_windows(click_hist: DataFrame, keys=()) -> DataFrame:
    return windowed_sums(click_hist, [*keys, "role_id"], "cnt", ROLE_CLICK_WINDOWS, lambda n: f"cnt_{n}_user")


def role_buy_windows(buy_hist: DataFrame, keys=()) -> DataFrame:
    return windowed_sums(buy_hist, [*keys, "role_id"], "buy_num", ROLE_BUY_WINDOWS,
                         lambda n: f"buy_num_{n}_user")


def item_click_windows(click_hist: DataFrame, keys=()) -> DataFrame:
    return windowed_sums(click_hist, [*keys, "item_id"], "cnt", ITEM_CLICK_WINDOWS, lambda n: f"cnt_{n}_item")


def item_buy_windows(buy_hist: DataFrame, keys=()) -> DataFrame:
    return windowed_sums(buy_hist, [*keys, "item_id"], "buy_num", ITEM_BUY_WINDOWS,
                         lambda n: f"buy_num_{n}_item")


def role_profile(role_daily: DataFrame, active_roles: DataFrame, asof,
                 drop=("dt", "server", "os")) -> DataFrame:
    """Role daily features of the day before ``asof``, active roles only (Q8)."""
    prev = shift(asof, -1)
    snap = restrict(on_day(role_daily, prev), roles_on(active_roles, prev))
    return snap.drop(*[c for c in drop if c in snap.columns])


def new_items(new_item_table: DataFrame, asof, days: int = NEW_ITEM_RECENT_DAYS) -> DataFrame:
    """Items first sold within the last ``days`` days: ``newdt > asof - days``."""
    return new_item_table.where(F.col("newdt") > F.lit(shift(asof, -days))).select("item_id")


def item_is_new(catalog: DataFrame, new_item_table: DataFrame, asof, band=NEW_ITEM_BAND) -> DataFrame:
    """Catalog with ``is_new`` = first sold in ``(asof-14, asof-7)``."""
    lo, hi = band
    recent = (new_item_table.where((F.col("newdt") > F.lit(shift(asof, -lo)))
                                   & (F.col("newdt") < F.lit(shift(asof, -hi))))
              .select("item_id").distinct().withColumn("_new", F.lit(1)))
    return (catalog.select("item_id").join(recent, "item_id", "left")
            .select("item_id", F.coalesce(F.col("_new"), F.lit(0)).cast("bigint").alias("is_new")))


def role_features(profile: DataFrame, click_hist: DataFrame, buy_hist: DataFrame, keys=()) -> DataFrame:
    """Role profile + click and buy window totals, 0-filled (Q6/Q7 role grain, A7)."""
    return attach(profile, [*keys, "role_id"],
                  [role_click_windows(click_hist, keys), role_buy_windows(buy_hist, keys)])


def item_features(items: DataFrame, click_hist: DataFrame, buy_hist: DataFrame, keys=()) -> DataFrame:
    """Item flags + click and buy window totals, 0-filled (Q6/Q7 item grain, A8)."""
    return attach(items, [*keys, "item_id"],
                  [item_click_windows(click_hist, keys), item_buy_windows(buy_hist, keys)])


def role_profile_days(role_daily: DataFrame, active_roles: DataFrame, days,
                      drop=("dt", "server", "os")) -> DataFrame:
    """(asof, role_id, <role features>): the day-before slice for each as-of day,
    active roles only (Q8 for several days)."""
    prev = [shift(d, -1) for d in as_of_days(days)]
    snap = (role_daily.where(day_in("dt", prev)).withColumn("asof", F.date_add("dt", 1))
            .join(active_before(active_roles, days), ["role_id", "asof"], "left_semi"))
    return snap.drop(*[c for c in drop if c in snap.columns])


def item_is_new_days(catalog: DataFrame, new_item_table: DataFrame, days, band=NEW_ITEM_BAND) -> DataFrame:
    """(asof, item_id, is_new) for each as-of day: catalog x days rows."""
    lo, hi = band
    arr = F.array(*[F.lit(d) for d in as_of_days(days)])
    recent = (new_item_table.select("item_id", "newdt", F.explode(arr).alias("asof"))
              .where((F.col("newdt") > F.date_sub("asof", lo)) & (F.col("newdt") < F.date_sub("asof", hi)))
              .select("asof", "item_id").distinct().withColumn("_new", F.lit(1)))
    base = catalog.select("item_id", F.explode(arr).alias("asof"))
    return (base.join(recent, ["asof", "item_id"], "left")
            .select("asof", "item_id", F.coalesce(F.col("_new"), F.lit(0)).cast("bigint").alias("is_new")))


def top_sellers(buy_log: DataFrame, active_roles: DataFrame, catalog: DataFrame, asof,
                days: int = TOP_SELLER_DAYS, n: int = TOP_SELLER_N) -> DataFrame:
    """Best-selling catalog items over the last ``days`` days before ``asof``."""
    day = to_day(asof)
    recent = buy_log.where((F.col("dt") > F.lit(shift(day, -(days + 1)))) & (F.col("dt") < F.lit(day)))
    recent = restrict(recent, roles_on(active_roles, shift(day, -1)), catalog)
    return top_items(recent, "buy_num", n).select("item_id", F.col("total").cast("bigint").alias("buy_num"))
