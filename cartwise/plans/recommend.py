"""Rank the catalog for each buyer of a day and score the ranking (Q12, Q15).

Two modes, as in the original (R32):

* ``recommend_list``      -- score buyers x catalog, drop items the role already
                             bought, put the top sellers first (the main mode);
* ``default_filled_rank`` -- rank a role's scored pairs, every other catalog
                             item gets a default score (0.05), nothing pruned.

The per-role Python loop of the original becomes one left join for the
pruning flags and one ``row_number`` per role; a role's window holds at most
one row per catalog item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.constants import DEFAULT_FILL_SCORE, HIT_KS, RANK_BLACKLIST
from cartwise.functions.dates import shift
from cartwise.operators.daily import before, on_day, restrict, roles_on
from cartwise.operators.joins import bucketed_grid
from cartwise.operators.ranking import rank_in_group
from cartwise.plans.training import AsOf

PAIR = ["role_id", "item_id"]


def candidate_grid(buyers: DataFrame, catalog: DataFrame, n_items: int | None = None) -> DataFrame:
    """(role_id, item_id): every catalog item for every buyer."""
    return bucketed_grid(buyers.select("role_id"), catalog.select("item_id"), n_items=n_items)


def candidate_features(grid: DataFrame, f: AsOf, pairs: DataFrame) -> DataFrame:
    """Grid rows with role, item and pair features; absent values 0."""
    feats = [c for c in pairs.columns if c not in PAIR]
    out = (grid.join(f.roles, "role_id", "left").join(f.items, "item_id", "left")
           .join(pairs, PAIR, "left"))
    return out.fillna(0, subset=feats)


def heuristic_score(df: DataFrame) -> DataFrame:
    """Deterministic stand-in score (used where a learned score would make the
    result engine-dependent): recent pair clicks and buys, then item sales."""
    s = ((F.col("cnt_7") * 3 + F.col("cnt_21") + F.col("buy_num_21") * 2) * 1000
         + F.coalesce(F.col("buy_num_21_item"), F.lit(0)))
    return df.withColumn("score", s.cast("double"))


def previous_buys(buy_log: DataFrame, catalog: DataFrame, asof) -> DataFrame:
    """Distinct (role, item) bought before ``asof``, catalog items only."""
    return restrict(before(buy_log, asof), items=catalog).select(*PAIR).distinct()


def candidate_prune(grid: DataFrame, top: DataFrame, bought: DataFrame) -> DataFrame:
    """Grid less top sellers and less items the role already bought (F8)."""
    return (grid.join(top.select("item_id"), "item_id", "left_anti")
            .join(bought, PAIR, "left_anti"))


def sellers_ranked(top: DataFrame) -> DataFrame:
    """(item_id, _seller_rank) of the bounded top-n list: its unpartitioned window covers n rows."""
    return top.select("item_id", F.row_number().over(
        Window.orderBy(F.col("buy_num").desc(), F.col("item_id").asc())).alias("_seller_rank"))


def recommend_list(scored: DataFrame, top: DataFrame, bought: DataFrame, limit: int | None = None) -> DataFrame:
    """(role_id, item_id, score, position): top sellers first, then the pruned
    candidates by score desc, item asc; zero-based positions (U3, W4, T3).

    With ``limit`` only the first positions of each role: the limit then runs inside
    every task before the shuffle (a group limit), so no role's whole catalog is sorted.
    """
    flagged = (scored.join(F.broadcast(sellers_ranked(top)), "item_id", "left")
               .join(bought.withColumn("_bought", F.lit(1)), PAIR, "left"))
    kept = flagged.where(F.col("_seller_rank").isNotNull() | F.col("_bought").isNull())
    w = Window.partitionBy("role_id").orderBy(F.col("_seller_rank").asc_nulls_last(), F.col("score").desc(),
                                              F.col("item_id").asc())
    rows = kept.select("role_id", "item_id", "score", F.row_number().over(w).alias("_place"))
    if limit is not None:
        rows = rows.where(F.col("_place") <= limit)
    return rows.select("role_id", "item_id", "score", (F.col("_place") - 1).cast("bigint").alias("position"))


def default_filled_rank(grid: DataFrame, scored_pairs: DataFrame, default: float = DEFAULT_FILL_SCORE) -> DataFrame:
    """(role_id, item_id, score, position): the role's scored pairs, every other
    catalog item at ``default`` (J11, R12)."""
    j = grid.join(scored_pairs.select(*PAIR, "score"), PAIR, "left")
    j = j.withColumn("score", F.coalesce(F.col("score"), F.lit(float(default))))
    return rank_in_group(j, "role_id", "score", "position", zero_based=True).select(
        "role_id", "item_id", "score", "position")


def day_purchases(buy_log: DataFrame, active_roles: DataFrame, asof) -> DataFrame:
    """Purchase rows of ``asof`` by roles active the day before (the evaluation set)."""
    return restrict(on_day(buy_log, asof), roles_on(active_roles, shift(asof, -1)))


def _report(j: DataFrame, found, missed, skip, ks) -> DataFrame:
    """hit@k, revenue@k and the counts of the purchases ``j`` (position, price)."""
    aggs = []
    for k in ks:
        hit = found & (F.col("position") < k)
        aggs.append(F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias(f"hit_{k}"))
        aggs.append(F.sum(F.when(hit, F.col("price")).otherwise(0.0)).alias(f"revenue_{k}"))
    aggs += [F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(n)
             for n, c in (("total", found), ("missed", missed), ("skipped", skip))]
    out = j.agg(*aggs)
    return out.withColumns({f"hit_rate_{k}": F.try_divide(F.col(f"hit_{k}") * 100.0, F.col("total"))
                            for k in ks})


def hit_revenue_at_k(ranked: DataFrame, purchases: DataFrame, ks=HIT_KS,
                     blacklist=RANK_BLACKLIST) -> DataFrame:
    """hit@k and revenue@k over a day's purchases (A16, R20, R21), from whole lists.

    ``total`` counts purchases found in the role's list; purchases of
    blacklisted items are ``skipped``; purchases pruned from the list are
    ``missed`` and count in neither.
    """
    j = purchases.select("role_id", "item_id", "price").join(ranked.select(*PAIR, "position"), PAIR, "left")
    skip = F.col("item_id").isin(list(blacklist))
    return _report(j, (~skip) & F.col("position").isNotNull(), (~skip) & F.col("position").isNull(), skip, ks)


def hit_revenue_from_top(ranked: DataFrame, purchases: DataFrame, catalog: DataFrame, top: DataFrame,
                         bought: DataFrame, ks=HIT_KS, blacklist=RANK_BLACKLIST) -> DataFrame:
    """``hit_revenue_at_k`` from lists cut at the largest k (``recommend_list`` with
    ``limit``). Whether a purchase is in the whole list is read from the sets that made it:
    its item is a candidate, and it is a top seller or was not bought before. Only
    purchases are joined, never the grid."""
    mark = lambda df, name, keys: df.select(*keys).distinct().withColumn(name, F.lit(True))
    j = (purchases.select("role_id", "item_id", "price")
         .join(mark(catalog, "_candidate", ["item_id"]), "item_id", "left")
         .join(F.broadcast(mark(top, "_seller", ["item_id"])), "item_id", "left")
         .join(mark(bought, "_bought", PAIR), PAIR, "left")
         .join(ranked.select(*PAIR, "position"), PAIR, "left"))
    skip = F.col("item_id").isin(list(blacklist))
    listed = F.col("_candidate").isNotNull() & (F.col("_seller").isNotNull() | F.col("_bought").isNull())
    return _report(j, (~skip) & listed, (~skip) & ~listed, skip, ks)
