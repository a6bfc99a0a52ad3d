"""Item statistics: popularity order and item-item correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.ranking import order_positions


def popularity(interactions: DataFrame, catalog: DataFrame) -> DataFrame:
    """(item_id, n, position): interaction rows per catalog item, most first."""
    counts = (interactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
              .join(catalog.select("item_id"), "item_id", "left_semi"))
    return order_positions(counts, "n")


def pearson(n, sx, sy, sxy, sxx, syy):
    """Pearson correlation from per-pair sums, in doubles (no integer overflow);
    NULL when a side has no variance."""
    n, sx, sy, sxy, sxx, syy = (c.cast("double") for c in (n, sx, sy, sxy, sxx, syy))
    num = n * sxy - sx * sy
    den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    return F.when(den > 0, num / den)


def item_correlation(interactions: DataFrame, items_a, items_b, value: str = "num",
                     pre_aggregated: bool = False) -> DataFrame:
    """Pearson correlation of two items' per-role totals over roles having both.

    ``items_a`` / ``items_b`` are lists, one-column (``item_id``) DataFrames, or None
    for all items (no join).
    Role x item totals are pre-aggregated (A18), so each role contributes at
    most |a| x |b| pairs; the sums are exact integers and the ratio is taken last.
    """
    if pre_aggregated:  # already one row per (role, item)
        totals = interactions.select("role_id", "item_id", F.col(value).cast("bigint").alias("q"))
    else:
        totals = interactions.groupBy("role_id", "item_id").agg(F.sum(value).cast("bigint").alias("q"))

    def pick(items, name):
        if items is None:
            sel = totals
        elif isinstance(items, DataFrame):
            sel = totals.join(items.select("item_id"), "item_id", "left_semi")
        else:
            sel = totals.where(F.col("item_id").isin(list(items)))
        return sel.select("role_id", F.col("item_id").alias(name), F.col("q").alias(f"q_{name}"))

    a, b = pick(items_a, "item1"), pick(items_b, "item2")
    # sums of products in 38 digits: exact, and no 64-bit overflow
    x, y = F.col("q_item1").cast("decimal(19,0)"), F.col("q_item2").cast("decimal(19,0)")
    s = a.join(b, "role_id").groupBy("item1", "item2").agg(
        F.count(F.lit(1)).alias("n_roles"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"))
    return s.select("item1", "item2", "n_roles",
                    pearson(F.col("n_roles"), F.col("sx"), F.col("sy"), F.col("sxy"), F.col("sxx"),
                            F.col("syy")).alias("corr"))
