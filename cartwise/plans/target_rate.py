"""Item identity as a model input: ordered target rates (P13, Q9 into M8).

A one-hot of the catalog costs a tree learner a column per item. Here an item is told by
one number: the share of its labelled rows that were bought on strictly earlier as-of
days, drawn towards the rate of all items by ``ITEM_RATE_PRIOR`` rows. No row sees its
own day's labels or later ones, so the column leaks nothing into the fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.constants import ITEM_RATE_PRIOR
from cartwise.functions.dates import to_day
from cartwise.operators.joins import bounded_broadcast
from cartwise.session import materialize


def item_rates(rows: DataFrame, items: DataFrame | None = None, days=()) -> DataFrame:
    """(asof, item_id, item_rate) for every (as-of day, item) of the labelled ``rows``,
    and for every one of ``items`` on each of ``days`` (days to be scored).

    With n rows and p bought ones of the item, N and P of all items, all on earlier days:
    ``(p + prior * P / N) / (n + prior)``; 0 where there is no earlier day. The rows are
    summed per (day, item) first, map-side combined; the running sums then read one row
    per day and item, and the totals one row per day.
    """
    counts = rows.groupBy("asof", "item_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("p"))
    for day in days:
        extra = items.select(F.lit(to_day(day)).alias("asof"), "item_id", F.lit(0).cast("bigint").alias("n"),
                             F.lit(0).cast("bigint").alias("p"))
        counts = counts.unionByName(extra)
    if days:
        counts = counts.groupBy("asof", "item_id").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    counts = materialize(counts)
    before = lambda w: w.orderBy("asof").rowsBetween(Window.unboundedPreceding, -1)
    by_item = before(Window.partitionBy("item_id"))
    by_day = before(Window.partitionBy(F.lit(0)))  # one row per as-of day
    totals = counts.groupBy("asof").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).select(
        "asof", F.sum("n").over(by_day).alias("_n"), F.sum("p").over(by_day).alias("_p"))
    own = counts.select("asof", "item_id", F.coalesce(F.sum("n").over(by_item), F.lit(0)).alias("n"),
                        F.coalesce(F.sum("p").over(by_item), F.lit(0)).alias("p"))
    prior = F.lit(float(ITEM_RATE_PRIOR))
    rate = (F.col("p") + prior * (F.col("_p") / F.col("_n"))) / (F.col("n") + prior)
    return own.join(F.broadcast(totals), "asof").select(
        "asof", "item_id", F.coalesce(F.when(F.col("_n") > 0, rate), F.lit(0.0)).alias("item_rate"))


def with_item_rate(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` with the column ``item_rate`` of their day and item; 0 for items without rates."""
    rates = materialize(rates)
    return rows.join(bounded_broadcast(rates, rates.count()), ["asof", "item_id"], "left") \
        .withColumn("item_rate", F.coalesce("item_rate", F.lit(0.0)))
