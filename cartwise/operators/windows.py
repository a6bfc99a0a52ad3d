"""Windowed sums at pair, role and item grain.

The original attaches each look-back window with its own filter + group-by +
self-join. Here every window of a grain is one conditional aggregate over the
day-grain rows: one shuffle per grain, no self-join (J3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.exprs import safe_ratio, window_sum


def windowed_sums(daily: DataFrame, keys: list[str], value: str, windows, name) -> DataFrame:
    """``groupBy(keys)`` with ``name(n) = sum(if(age <= n, value, 0))`` per window."""
    aggs = [window_sum(value, "age", n).cast("bigint").alias(name(n)) for n in windows]
    return daily.groupBy(*keys).agg(*aggs)


def window_row_counts(daily: DataFrame, windows) -> dict:
    """Number of day-grain rows with ``age <= n`` per window, as one scalar
    subquery (a single global aggregate whose final merge sees one partial row
    per partition) returning a struct."""
    totals = daily.select(F.struct(*[F.count_if(F.col("age") <= n).alias(f"n{n}") for n in windows])).scalar()
    return {n: totals.getField(f"n{n}") for n in windows}


def with_shares(pairs: DataFrame, daily: DataFrame, windows, value_name, share_name,
                keys: list[str] | None = None) -> DataFrame:
    """``share(n) = value(n) / rows of daily with age <= n``, 0 when undefined.

    With ``keys`` (e.g. the as-of day) the denominators are per key: one small
    aggregate, one row per key, broadcast back."""
    if not keys:
        totals = window_row_counts(daily, windows)
        return pairs.withColumns({share_name(n): safe_ratio(F.col(value_name(n)), totals[n], 0.0)
                                  for n in windows})
    counts = daily.groupBy(*keys).agg(*[F.count_if(F.col("age") <= n).alias(f"_n{n}") for n in windows])
    out = pairs.join(F.broadcast(counts), list(keys), "left")
    out = out.withColumns({share_name(n): safe_ratio(F.col(value_name(n)), F.col(f"_n{n}"), 0.0)
                           for n in windows})
    return out.drop(*[f"_n{n}" for n in windows])


def attach(base: DataFrame, key, parts: list[DataFrame]) -> DataFrame:
    """Left-join per-key aggregates onto a base table, filling 0."""
    keys = [key] if isinstance(key, str) else list(key)
    out = base
    filled = []
    for p in parts:
        out = out.join(p, keys, "left")
        filled += [c for c in p.columns if c not in keys]
    return out.fillna(0, subset=filled)


def masked_daily(daily: DataFrame, value: str, windows=((1, "1"), (3, "3"), (7, "week"), (30, "month")),
                 prefix: str | None = None) -> DataFrame:
    """Per-day masked values ``value_N = value if age <= N else 0`` (A10)."""
    p = prefix or value
    return daily.withColumns({f"{p}_{name}": F.when(F.col("age") <= n, F.col(value)).otherwise(F.lit(0))
                              .cast("bigint") for n, name in windows})


def item_total_flag(df: DataFrame, value: str = "num", item: str = "item_id", out: str = "num_s") -> DataFrame:
    """1 when the row's value reaches the item's total over all rows, else 0.

    The item total is a partial aggregate joined back (not a window), so a hot
    item's rows are never gathered into one task.
    """
    totals = df.groupBy(item).agg(F.sum(value).alias("_item_total"))
    return (df.join(totals, item)
            .withColumn(out, F.when(F.col(value) >= F.col("_item_total"), 1).otherwise(0).cast("bigint"))
            .drop("_item_total"))
