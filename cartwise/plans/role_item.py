"""Role x item mall feature table (Q1, the flagship).

One row per (role, item) clicked in the ``day_num``-day window ending on the
as-of day, with click, purchase, recency, open and guarded-CTR columns.

Semantics kept from the original (see the README's register):

* click / buy windows are ``age <= N`` (so "day" is ages 0 and 1); open
  windows are ``age < N``; "month" sums the whole scanned window (R3, R4);
* week active days are the distinct days with ``age <= 7`` (R2);
* ``rn_*_week`` ties are broken by ``item_id`` ascending (R22).

Plan: the click log is scanned and exploded once into day-grain counts
(combined map-side), checkpointed, and read by the click and the open
branches; day-grain rows are hash-partitioned by role once, which serves the
pair aggregate, the per-role rank window and the role-keyed joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import (CTR_FLOORS, MISSING_BUY, MISSING_CLICK, MISSING_DAY, MISSING_GAP,
                                MISSING_RANK, OPEN_WINDOWS, RI_WINDOWS, TAB_CLOTH, TAB_MALL)
from cartwise.functions.dates import age, to_day
from cartwise.functions.exprs import guarded_ctr, recency_gap, window_sum
from cartwise.operators.daily import daily_buys, daily_clicks, daily_opens, log_counts
from cartwise.operators.ranking import rank_in_group
from cartwise.session import materialize

WINDOW_NAMES = [n for n, _ in RI_WINDOWS] + ["month"]


def _windowed(value: str, prefix: str) -> list:
    cols = [window_sum(value, "age", n).cast("bigint").alias(f"{prefix}_{name}") for name, n in RI_WINDOWS]
    return cols + [F.sum(value).cast("bigint").alias(f"{prefix}_month")]


def _active_days(prefix: str) -> list:
    # the input has one row per (role, item, age): distinct days = rows
    return [F.count(F.lit(1)).alias(f"{prefix}_month"),
            F.sum(F.when(F.col("age") <= 7, 1).otherwise(0)).cast("bigint").alias(f"{prefix}_week")]


def by_role(daily: DataFrame) -> DataFrame:
    """Hash-partition day-grain rows by role. A role has at most (catalog items x
    days) such rows, so even a hot role is a bounded task, and the pair aggregate,
    the per-role window and the role-keyed joins that follow need no further
    shuffle of the pair rows."""
    return daily.repartition("role_id")


def pair_clicks(click_log: DataFrame, asof, day_num: int = 30, counts: DataFrame | None = None) -> DataFrame:
    """Click side: windows of clicks and distinct-tab clicks, days, recency, rank.

    ``counts`` (from ``log_counts``) is expected hash-partitioned by role already;
    without it the day-grain rows are partitioned here."""
    d = daily_clicks(click_log, asof, day_num, counts)
    if counts is None:
        d = by_role(d)
    g = d.groupBy("role_id", "item_id").agg(
        *_windowed("click_num_day", "click_num"),
        *_windowed("click_num_dis_day", "click_num_dis"),
        *_active_days("click_day"),
        F.min("age").alias("final_click_day"))
    return rank_in_group(g, "role_id", "click_num_week", "rn_click_week")


def pair_buys(buy_log: DataFrame, asof, day_num: int = 30) -> DataFrame:
    """Buy side: windows of purchases, days, recency, rank."""
    d = by_role(daily_buys(buy_log, asof, day_num))
    g = d.groupBy("role_id", "item_id").agg(
        *_windowed("buy_num_day", "buy_num"),
        *_active_days("buy_day"),
        F.min("age").alias("final_buy_day"))
    return rank_in_group(g, "role_id", "buy_num_week", "rn_buy_week")


def role_opens(click_log: DataFrame, asof, day_num: int = 30, counts: DataFrame | None = None) -> DataFrame:
    """Opens per role: 2 tabs x (``age < 1``, ``< 3``, ``< 7``, all)."""
    d = daily_opens(click_log, asof, day_num, counts=counts)
    cols = []
    for tab in (TAB_CLOTH, TAB_MALL):
        is_tab = F.col("child_tab") == tab
        cols += [window_sum("open_num_day", "age", n, strict=True, extra=is_tab).cast("bigint")
                 .alias(f"{tab}_{name}") for name, n in OPEN_WINDOWS]
        cols.append(window_sum("open_num_day", "age", None, extra=is_tab).cast("bigint").alias(f"{tab}_month"))
    return d.groupBy("role_id").agg(*cols)


def role_online(role_profile: DataFrame, asof) -> DataFrame:
    """(role_id, role_final_day): age of the role's last online day, as of ``asof``."""
    snap = role_profile.where(F.col("dt") == F.lit(to_day(asof)))
    return snap.select("role_id", age("role_final_dt", asof).alias("role_final_day"))


def role_item_features(click_log: DataFrame, buy_log: DataFrame, role_profile: DataFrame,
                       asof, day_num: int = 30, ctr_floors: dict | None = None) -> DataFrame:
    """The 40-column role x item feature table as of ``asof`` (Q1)."""
    floors = ctr_floors or CTR_FLOORS
    # the log is scanned and exploded once; its day-grain counts are written once
    # and read by both the click and the open branch
    # counts are at most (tabs x days x catalog) rows per role: partitioned by role
    # once, they serve the day and pair aggregates, the rank window and the opens
    counts = by_role(materialize(log_counts(click_log, asof, day_num)))
    clicks = pair_clicks(click_log, asof, day_num, counts)
    buys = pair_buys(buy_log, asof, day_num)
    online = role_online(role_profile, asof)
    opens = role_opens(click_log, asof, day_num, counts)
    j = (clicks.join(buys, ["role_id", "item_id"], "left")
         .join(online, "role_id", "left")
         .join(opens, "role_id", "left"))
    c = F.col
    out = [c("role_id"), c("item_id")]
    out += [F.coalesce(c(f"buy_num_{w}"), F.lit(MISSING_BUY)).cast("bigint").alias(f"buy_num_{w}")
            for w in WINDOW_NAMES]
    out += [F.coalesce(c(f"buy_day_{w}"), F.lit(MISSING_BUY)).cast("bigint").alias(f"buy_day_{w}")
            for w in ("week", "month")]
    out.append(F.coalesce(c("final_click_day"), F.lit(MISSING_DAY)).alias("final_click_day"))
    out += [F.coalesce(c(f"click_num_{w}"), F.lit(MISSING_CLICK)).cast("bigint").alias(f"click_num_{w}")
            for w in WINDOW_NAMES]
    out += [F.coalesce(c(f"click_day_{w}"), F.lit(MISSING_CLICK)).cast("bigint").alias(f"click_day_{w}")
            for w in ("week", "month")]
    out += [F.coalesce(c(f"click_num_dis_{w}"), F.lit(MISSING_CLICK)).cast("bigint")
            .alias(f"click_num_dis_{w}") for w in WINDOW_NAMES]
    out += [F.coalesce(c("rn_click_week"), F.lit(MISSING_RANK)).cast("bigint").alias("rn_click_week"),
            F.coalesce(c("rn_buy_week"), F.lit(MISSING_RANK)).cast("bigint").alias("rn_buy_week"),
            F.coalesce(c("final_buy_day"), F.lit(MISSING_DAY)).alias("final_buy_day"),
            recency_gap("role_final_day", "final_buy_day", MISSING_GAP).alias("final_buy_gap"),
            c("role_final_day")]
    for tab in (TAB_CLOTH, TAB_MALL):
        out += [F.coalesce(c(f"{tab}_{w}"), F.lit(0)).cast("bigint").alias(f"{tab}_{w}") for w in WINDOW_NAMES]
    for tab in (TAB_CLOTH, TAB_MALL):
        out += [guarded_ctr(f"click_num_dis_{w}", f"{tab}_{w}", floors[tab][w]).alias(f"{tab}_ctr_{w}")
                for w in WINDOW_NAMES]
    return j.select(*out)
