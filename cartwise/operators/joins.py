"""Join helpers: semi-join filters, size-checked broadcast, bucketed candidate grids."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is broadcast only while its counted rows times its row size are at most this.
BROADCAST_MAX_BYTES = 32 << 20
_WIDE = 64  # bytes assumed for a string, array or other value without a fixed size


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row by its schema: 8 for fixed-size values, ``_WIDE`` for others."""
    fixed = ("bigint", "int", "double", "float", "date", "timestamp", "smallint", "tinyint", "boolean")
    return 16 + sum(8 if kind in fixed else _WIDE for _, kind in df.dtypes)


def bounded_broadcast(df: DataFrame, rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The broadcast hint only where ``rows`` counted rows are within ``max_bytes``;
    beyond it a shuffle join, which AQE may still switch from real sizes."""
    return F.broadcast(df) if rows * row_bytes(df) <= max_bytes else df


def bucketed_grid(keys: DataFrame, items: DataFrame, items_per_bucket: int = 512,
                  item: str = "item_id", n_items: int | None = None) -> DataFrame:
    """Every row of ``keys`` paired with every row of ``items`` (the candidate grid).

    Written as an equi-join on an item bucket: items get ``pmod(hash(item), B)``,
    each key row is repeated once per bucket. Every join task emits
    keys x (one item slice), so the output, linear in ``keys`` for a fixed
    catalog, is spread over ``B`` buckets; no cartesian-product operator runs.
    ``B`` comes from a count of ``items`` (or ``n_items`` when the caller holds
    one); the item side is broadcast only under the counted bound.
    """
    if n_items is None:
        n_items = items.count()
    side = bounded_broadcast(items, n_items)
    buckets = max(1, math.ceil(n_items / items_per_bucket))
    it = side.withColumn("_bucket", F.pmod(F.hash(F.col(item)), F.lit(buckets)))
    ks = keys.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return ks.join(it, "_bucket").drop("_bucket")
