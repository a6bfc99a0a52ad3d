"""Implicit-feedback factorisation and its uses.

The original fits a single-machine WARP model on a sparse role x item matrix.
Here ``pyspark.ml.recommendation.ALS`` (implicit preferences, raw counts as
confidence, R14) fits the same kind of vectors with block-partitioned
alternating least squares; numbers differ by learner, the interfaces match.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.constants import (MF_BAND_DAYS, MF_CATALOG_BLACKLIST, MF_EPOCHS, MF_INTERACTION_BLACKLIST, MF_RANK,
                                UNSEEN_PAIR_SCORE)
from cartwise.operators.daily import as_of_days, band
from cartwise.operators.joins import bucketed_grid
from cartwise.operators.metrics import popularity
from cartwise.operators.ranking import dense_index, rank_in_group
from cartwise.operators.windows import item_total_flag
from cartwise.session import materialize

PAIR = ["role_id", "item_id"]
#: Ratings aimed at per ALS block; the block count follows the data.
RATINGS_PER_BLOCK = 1_000_000


def interactions(clicks: DataFrame, asof, days: int = MF_BAND_DAYS,
                 blacklist=MF_INTERACTION_BLACKLIST) -> DataFrame:
    """(role_id, item_id, dt, num, num_s): clicks of the week before ``asof``, less
    the blacklist, with the single-row weight flag (M4: F5, F4, P16)."""
    rows = band(clicks, asof, days).withColumnRenamed("cnt", "num")
    rows = rows.where(~F.col("item_id").isin(list(blacklist)))
    return item_total_flag(rows, "num")


def dense_ids(df: DataFrame, cols=("role_id", "item_id")) -> DataFrame:
    """Add ``<col>_index``: 0-based dense index of each id in id order.

    Distributed (range partitions of the distinct ids, in their own type), so the
    vocabulary never goes through the driver and ids beyond 2^53 stay apart; the
    inverse mapping is the same two columns read the other way.
    """
    df = materialize(df)
    for c in cols:
        df = df.join(dense_index(df, c, f"{c}_index"), c, "left") \
            .withColumn(f"{c}_index", F.col(f"{c}_index").cast("int"))
    return df


def id_maps(indexed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(role_id, role_id_index) and (item_id, item_id_index) mappings."""
    return (indexed.select("role_id", "role_id_index").distinct(),
            indexed.select("item_id", "item_id_index").distinct())


@dataclass
class Factors:
    model: ALSModel
    roles: DataFrame   # (role_id, features)
    items: DataFrame   # (item_id, features)
    train: DataFrame   # the interaction rows (popularity counts them)


def fit_factors(train: DataFrame, rank: int = MF_RANK, epochs: int = MF_EPOCHS, reg: float = 0.01,
                alpha: float = 1.0, seed: int = 7, weight: str = "num") -> Factors:
    """Implicit ALS on role x item counts (M3).

    Interaction rows are first summed per (role, item), as the original's sparse
    matrix sums duplicate entries; each role then has at most one ALS rating
    per catalog item, whatever its event volume."""
    pairs = train.groupBy("role_id", "item_id").agg(F.sum(weight).cast("double").alias(weight))
    indexed = materialize(dense_ids(pairs))  # the fit and both id maps read it
    blocks = max(10, -(-indexed.count() // RATINGS_PER_BLOCK))
    als = ALS(numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, maxIter=epochs, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
              userCol="role_id_index", itemCol="item_id_index", ratingCol=weight,
              coldStartStrategy="nan", nonnegative=False)
    model = als.fit(indexed)
    roles_map, items_map = id_maps(indexed)
    roles = model.userFactors.join(roles_map, F.col("id") == F.col("role_id_index")).select("role_id", "features")
    items = model.itemFactors.join(items_map, F.col("id") == F.col("item_id_index")).select("item_id", "features")
    return Factors(model, roles, items, train)


def factor_columns(vectors: DataFrame, key: str, suffix: str, rank: int = MF_RANK) -> DataFrame:
    """``features`` array -> ``{i}_{suffix}`` scalar columns (M5)."""
    return vectors.select(key, *[F.col("features")[i].cast("double").alias(f"{i}_{suffix}") for i in range(rank)])


def embedding_features(base: DataFrame, vectors: DataFrame, key: str, suffix: str,
                       rank: int = MF_RANK) -> DataFrame:
    """Left join factor columns onto a feature table, 0 when absent."""
    cols = factor_columns(vectors, key, suffix, rank)
    return base.join(cols, key, "left").fillna(0.0, subset=[c for c in cols.columns if c != key])


def dot(u, v):
    return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double"))


def pair_score(rows: DataFrame, f: Factors, out: str = "fm", unseen: float = UNSEEN_PAIR_SCORE) -> DataFrame:
    """Dot product of role and item vectors; ``unseen`` when either is missing (M6)."""
    r = f.roles.select("role_id", F.col("features").alias("_u"))
    i = f.items.select("item_id", F.col("features").alias("_i"))
    j = rows.join(r, "role_id", "left").join(i, "item_id", "left")
    score = F.when(F.col("_u").isNull() | F.col("_i").isNull(), F.lit(float(unseen))).otherwise(dot("_u", "_i"))
    return j.withColumn(out, score).drop("_u", "_i")


def recommend_fallback(test_roles: DataFrame, f: Factors, catalog: DataFrame,
                       catalog_blacklist=MF_CATALOG_BLACKLIST) -> DataFrame:
    """(role_id, item_id, score, position, source) for each test role (M7).

    Roles with a vector rank every catalog item that has one by predicted
    score; roles without one (first-time buyers) get the popularity order of
    the training interactions (A11, T2).
    """
    mf_catalog = catalog.where(~F.col("item_id").isin(list(catalog_blacklist))).select("item_id")
    roles = test_roles.select("role_id").distinct()
    unknown = roles.join(f.roles.select("role_id"), "role_id", "left_anti")
    scored = known_scores(roles, f, mf_catalog)
    mf = rank_in_group(scored, "role_id", "score", "position", zero_based=True) \
        .select("role_id", "item_id", "score", "position", F.lit("mf").alias("source"))
    pop = popularity(f.train, mf_catalog)
    fb = bucketed_grid(unknown, pop).select("role_id", "item_id", F.col("n").cast("double").alias("score"),
                                             "position", F.lit("popular").alias("source"))
    return mf.unionByName(fb)


def known_scores(roles: DataFrame, f: Factors, items: DataFrame) -> DataFrame:
    """(role_id, item_id, score) of every role and item that have a vector. The vectors
    go through the grid with their keys, so no pair is joined again."""
    u = f.roles.join(roles.select("role_id"), "role_id", "left_semi").withColumnRenamed("features", "_u")
    i = f.items.join(items.select("item_id"), "item_id", "left_semi").withColumnRenamed("features", "_i")
    return bucketed_grid(u, i).select("role_id", "item_id", dot("_u", "_i").alias("score"))


def fallback_positions(purchases: DataFrame, f: Factors, catalog: DataFrame,
                       catalog_blacklist=MF_CATALOG_BLACKLIST) -> DataFrame:
    """(role_id, item_id, position) of the purchased pairs in ``recommend_fallback``.
    Roles without a vector look their items up in the one popularity list, which is
    not copied per role."""
    mf_catalog = catalog.where(~F.col("item_id").isin(list(catalog_blacklist))).select("item_id")
    pairs = purchases.select(*PAIR).distinct()
    scored = known_scores(pairs.select("role_id").distinct(), f, mf_catalog)
    mf = rank_in_group(scored, "role_id", "score", "position", zero_based=True).join(pairs, PAIR, "left_semi")
    pop = popularity(f.train, mf_catalog).select("item_id", "position")
    fb = pairs.join(f.roles.select("role_id"), "role_id", "left_anti").join(pop, "item_id")
    return mf.select(*PAIR, "position").unionByName(fb.select(*PAIR, "position"))


def with_factor_features(rows: DataFrame, f: Factors, rank: int = MF_RANK, user: bool = True,
                         item: bool = True) -> DataFrame:
    """Training / test rows with the pair score ``fm`` and, when enabled, the role
    and item vectors as ``{i}_user_fm`` / ``{i}_item_fm`` columns, 0 when absent
    (M5, M6)."""
    out = pair_score(rows, f, "fm")
    if user:
        out = embedding_features(out, f.roles, "role_id", "user_fm", rank)
    if item:
        out = embedding_features(out, f.items, "item_id", "item_fm", rank)
    return out


def factor_features_days(rows: DataFrame, clicks: DataFrame, days, rank: int = MF_RANK,
                         unseen: float = UNSEEN_PAIR_SCORE, **als) -> DataFrame:
    """``with_factor_features`` for rows keyed by ``asof``: one ALS fit per as-of
    day on the week before it (as the original refits per training day); the
    vectors of all days are written once and joined on (asof, role) and
    (asof, item)."""
    role_parts, item_parts = [], []
    for d in as_of_days(days):
        fs = fit_factors(interactions(clicks, d), rank=rank, **als)
        role_parts.append(fs.roles.withColumn("asof", F.lit(d)))
        item_parts.append(fs.items.withColumn("asof", F.lit(d)))
    roles = materialize(reduce(DataFrame.unionByName, role_parts))
    items = materialize(reduce(DataFrame.unionByName, item_parts))
    j = (rows.join(roles.select("asof", "role_id", F.col("features").alias("_u")), ["asof", "role_id"], "left")
         .join(items.select("asof", "item_id", F.col("features").alias("_i")), ["asof", "item_id"], "left"))
    fm = F.when(F.col("_u").isNull() | F.col("_i").isNull(), F.lit(float(unseen))).otherwise(dot("_u", "_i"))
    cols = {"fm": fm}
    cols.update({f"{i}_user_fm": F.coalesce(F.col("_u")[i].cast("double"), F.lit(0.0)) for i in range(rank)})
    cols.update({f"{i}_item_fm": F.coalesce(F.col("_i")[i].cast("double"), F.lit(0.0)) for i in range(rank)})
    return j.withColumns(cols).drop("_u", "_i")
