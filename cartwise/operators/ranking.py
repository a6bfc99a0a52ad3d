"""Ranks and orders.

Per-role ranks are windows partitioned by role: a role's partition holds at
most one row per catalog item, so even a role with a third of all events
ranks a catalog-sized list.

Global ranks (one order over the whole table) never use an unpartitioned
window. ``global_ranks`` ranks the *histogram* of values (one row per
distinct value) in buckets, each one task; any monotone bucketing gives exact
ranks, the choice only balances the work:

* ``"log2"`` for non-negative counts: bucket ``floor(log2(v + 1))`` holds at
  most 2^k distinct integers and needs no cut-point pass;
* ``"quantile"`` for other numeric domains: cut points at approximate
  quantiles of the distinct values (one extra pass over a materialised input).

Values are ranked as doubles, which is exact for counts; ids are indexed in their
own type by ``dense_index``, over range partitions whose number follows the data.

    rank(v) = 1 + (weight of all buckets above v's bucket)
                + (weight of the values above v inside its bucket)

with weight 1 per distinct value for a dense rank and the row count per value
for a min rank. The per-bucket totals are at most ``buckets`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import materialize

DEFAULT_BUCKETS = 64


def _bucket_expr(v, cuts: list[float]):
    expr = F.lit(0)
    for c in cuts:
        expr = expr + F.when(v > F.lit(c), 1).otherwise(0)
    return expr


def rank_table(df: DataFrame, columns: list[str], method: str = "dense",
               buckets: int = DEFAULT_BUCKETS, rel_err: float = 1e-3, descending: bool = True,
               bucketing: str = "quantile", groups: list[str] | None = None) -> DataFrame:
    """(*groups, _col, _v, _rank): rank of every distinct value of each column
    within each group (e.g. each as-of day), largest first (``descending``) or
    smallest first.

    ``method="dense"``: ties share a rank, no gaps. ``method="min"``: ties share
    the lowest position, counting rows of ``df`` (pandas ``rank(method='min')``).
    """
    if method not in ("dense", "min"):
        raise ValueError(method)
    groups = list(groups or [])
    stacked = df.select(*groups, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in columns
    ])).alias("_s")).select(*groups, "_s._col", "_s._v").where(F.col("_v").isNotNull())
    if not descending:  # rank the negated values, report the originals
        stacked = stacked.withColumn("_v", -F.col("_v"))
    keys = groups + ["_col"]
    if method == "dense":
        hist = stacked.distinct().withColumn("_w", F.lit(1).cast("bigint"))
    else:
        hist = stacked.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w"))
    if bucketing == "log2":
        # monotone in _v (ascending ranks negate _v: mirror the buckets)
        b = F.floor(F.log2(F.abs(F.col("_v")) + 1)).cast("int")
        hist = hist.withColumn("_b", F.when(F.col("_v") >= 0, b).otherwise(-b - 1))
    else:
        probs = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(q for q in hist.approxQuantile("_v", probs, rel_err) if q is not None))
        hist = hist.withColumn("_b", _bucket_expr(F.col("_v"), cuts))
    totals = hist.groupBy(*keys, "_b").agg(F.sum("_w").alias("_bw"))
    above = Window.partitionBy(*keys).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_b", F.coalesce(F.sum("_bw").over(above), F.lit(0)).alias("_off"))
    inside = (Window.partitionBy(*keys, "_b").orderBy(F.col("_v").desc())
              .rowsBetween(Window.unboundedPreceding, -1))
    local = hist.select(*keys, "_v", "_b", F.coalesce(F.sum("_w").over(inside), F.lit(0)).alias("_pre"))
    # at most (#groups x #columns x buckets) rows (<= 2 x 64 buckets per column
    # for log2): a proven bound for the broadcast
    sign = 1.0 if descending else -1.0
    return (local.join(F.broadcast(offsets), keys + ["_b"])
            .select(*keys, (F.col("_v") * sign).alias("_v"),
                    (F.col("_off") + F.col("_pre") + 1).cast("bigint").alias("_rank")))


def global_ranks(df: DataFrame, outputs: dict[str, str], method: str = "dense",
                 buckets: int = DEFAULT_BUCKETS, descending: bool = True, materialized: bool = False,
                 bucketing: str = "quantile", groups: list[str] | None = None) -> DataFrame:
    """Add ``outputs[col]`` = rank of ``col`` over the whole table, or within each
    group of ``groups`` (W2/W3).

    The ranked frame is read by the histogram of every column and by the final
    joins (and by the cut-point pass with quantile buckets): unless the caller
    says it is already materialised it is written once first, so its lineage
    runs once instead of once per reader.
    """
    groups = list(groups or [])
    if not materialized:
        df = materialize(df)
    ranks = rank_table(df, list(outputs), method, buckets, descending=descending, bucketing=bucketing,
                       groups=groups)
    if len(outputs) > 1:
        # one row per distinct value and column: written once, so each join-back
        # reads it instead of re-deriving the ranks per column
        ranks = materialize(ranks)
    out = df
    for c, name in outputs.items():
        r = ranks.where(F.col("_col") == c).select(*[F.col(g).alias(f"_g_{g}") for g in groups],
                                                   F.col("_v").alias(f"_v_{name}"), F.col("_rank").alias(name))
        cond = F.col(c).cast("double") == F.col(f"_v_{name}")
        for g in groups:
            cond = cond & (F.col(g) == F.col(f"_g_{g}"))
        out = out.join(r, cond, "left").drop(f"_v_{name}", *[f"_g_{g}" for g in groups])
    return out


def rank_in_group(df: DataFrame, group: str, order_col: str, out: str, tie: str = "item_id",
                  zero_based: bool = False) -> DataFrame:
    """``row_number`` per group by ``order_col`` desc, ties by ``tie`` asc."""
    w = Window.partitionBy(group).orderBy(F.col(order_col).desc(), F.col(tie).asc())
    rn = F.row_number().over(w) - (1 if zero_based else 0)
    return df.withColumn(out, rn.cast("bigint"))


def top_items(df: DataFrame, value: str, n: int, key: str = "item_id") -> DataFrame:
    """Top ``n`` keys by summed ``value``, ties by key (T1). The limit is the feature;
    Spark plans a per-partition top-k and one small merge."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    return totals.orderBy(F.col("total").desc(), F.col(key).asc()).limit(n)


#: Rows aimed at per range partition of a global order.
RANGE_ROWS = 1_000_000


def range_positions(df: DataFrame, order: list, out: str = "position", rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Zero-based position of every row in the global order ``order`` (columns with
    their directions, a total order), exact and distributed.

    The rows are range-partitioned on the order itself, in as many ranges as their
    count asks for, and written with their range number; each range is numbered on
    its own and offset by the sizes of the ranges before it (one row per range).
    Columns keep their type: nothing is cast, so ids of any size stay apart.
    """
    df = materialize(df)
    ranges = max(1, -(-df.count() // rows_per_range))
    dealt = materialize(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_range").orderBy(*order)
    return (dealt.join(F.broadcast(offsets), "_range")
            .withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1).cast("bigint"))
            .drop("_range", "_off"))


def dense_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """(column, out): the zero-based position of every distinct non-null value, in its own type."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return range_positions(values, [F.col(column).asc()], out)


def order_positions(df: DataFrame, value: str, key: str = "item_id", out: str = "position") -> DataFrame:
    """Zero-based global position by ``value`` desc, ``key`` asc (T2). Rows of equal
    value are ordered by key like any others, so no task holds all of one value."""
    return range_positions(df, [F.col(value).desc(), F.col(key).asc()], out)
