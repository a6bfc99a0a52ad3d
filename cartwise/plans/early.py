"""Early feature variant: day-grain click / buy features and their cross (Q2-Q4).

Rows stay at (role, item, day) grain with masked per-day windows, the pair's
last-event age and recency flags, and a global *min* rank (pandas
``rank(method='min')``) counted over the day-grain rows (R8). The cross
features reduce each side to one row per pair before joining (R30).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.constants import MASKED_WINDOWS
from cartwise.functions.exprs import flag, safe_ratio
from cartwise.operators.ranking import global_ranks
from cartwise.operators.windows import masked_daily

PAIR = ["role_id", "item_id"]


def _pair_min_age(df: DataFrame, out: str) -> DataFrame:
    # a pair's partition holds one row per day of history: bounded by the look-back
    return df.withColumn(out, F.min("age").over(Window.partitionBy(*PAIR)))


def daily_click_features(click_hist: DataFrame) -> DataFrame:
    """Per (role, item, day): ``cnt``, ``cnt_{1,3,week,month}``, last-click age,
    ``final_click_dt_{1,3,week}`` and ``rank_week`` (Q2)."""
    d = masked_daily(click_hist, "cnt", MASKED_WINDOWS)
    d = _pair_min_age(d, "d_dt_final_click")
    d = d.withColumns({"final_click_dt_1": flag(F.col("d_dt_final_click") <= 1),
                       "final_click_dt_3": flag(F.col("d_dt_final_click") <= 3),
                       "final_click_dt_week": flag(F.col("d_dt_final_click") <= 7)})
    return global_ranks(d, {"cnt_week": "rank_week"}, method="min", bucketing="log2").drop("age")


def daily_buy_features(buy_hist: DataFrame) -> DataFrame:
    """Per (role, item, day): ``buy_num``, ``buy_num_{1,3,week,month}``, last-buy
    age, ``final_buy_dt_{1,3}`` and ``buy_rank_week`` (Q3)."""
    d = masked_daily(buy_hist, "buy_num", MASKED_WINDOWS)
    d = _pair_min_age(d, "d_dt_buy_final")
    d = d.withColumns({"final_buy_dt_1": flag(F.col("d_dt_buy_final") <= 1),
                       "final_buy_dt_3": flag(F.col("d_dt_buy_final") <= 3)})
    return global_ranks(d, {"buy_num_week": "buy_rank_week"}, method="min", bucketing="log2").drop("age")


def _per_pair(daily: DataFrame, sums: list[str], mins: list[str]) -> DataFrame:
    return daily.groupBy(*PAIR).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums],
                                     *[F.min(c).alias(c) for c in mins])


def cross_features(click_daily: DataFrame, buy_daily: DataFrame) -> DataFrame:
    """One row per clicked pair with buy-side columns, a recency ratio ``ctr`` =
    last-buy age / last-click age, and ``label`` = pair bought (Q4, P11)."""
    c = _per_pair(click_daily, ["cnt"] + [f"cnt_{n}" for _, n in MASKED_WINDOWS],
                  ["d_dt_final_click", "final_click_dt_1", "final_click_dt_3", "final_click_dt_week", "rank_week"])
    b = _per_pair(buy_daily, ["buy_num"] + [f"buy_num_{n}" for _, n in MASKED_WINDOWS],
                  ["d_dt_buy_final", "final_buy_dt_1", "final_buy_dt_3", "buy_rank_week"])
    j = c.join(b, PAIR, "left")
    j = j.withColumns({"ctr": safe_ratio("d_dt_buy_final", "d_dt_final_click", None),
                       "label": flag(F.col("d_dt_buy_final").isNotNull())})
    return j.fillna(0)
