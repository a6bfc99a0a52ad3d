"""Learned scores: boosted trees, factorisation machine, one-hot encodings
(M8-M11, P13, P15).

The original trains a single-machine leaf-wise GBDT and a single-machine FM; here the
trees are fitted by ``boosting`` from distributed histograms and ``FMClassifier`` trains
data-parallel. The ranking metric (hit@k / revenue@k) is the comparable output.
"""

from __future__ import annotations

from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.constants import HOLDOUT_FRACTION, HOLDOUT_SEED, MF_RANK
from cartwise.operators.ranking import dense_index
from cartwise.plans import boosting
from cartwise.plans.boosting import Boosted
from cartwise.session import materialize

NON_FEATURES = ("role_id", "item_id", "label", "asof", "is_val", "score", "position", "dt")
HOLDOUT_KEYS = ("role_id", "item_id", "asof")
NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType)


def feature_columns(df: DataFrame, exclude=NON_FEATURES) -> list[str]:
    """Numeric columns usable as model inputs (ids, labels and dates excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def holdout_split(df: DataFrame, fraction: float = HOLDOUT_FRACTION, seed: int = HOLDOUT_SEED,
                  keys=HOLDOUT_KEYS, out: str = "is_val") -> DataFrame:
    """Flag a seeded ``fraction`` of rows as validation (M9). The flag hashes the
    row keys, so it does not depend on partitioning or on re-execution."""
    cols = [F.col(k) for k in keys if k in df.columns]
    u = F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1_000_000)) / 1_000_000.0
    return df.withColumn(out, u < F.lit(fraction))


def index_column(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based dense index of a categorical column, computed distributed (no
    driver-side vocabulary)."""
    out = out or f"{col}_idx"
    df = materialize(df)
    return df.join(dense_index(df, col, out), col, "left").withColumn(out, F.col(out).cast("double"))


def one_hot(df: DataFrame, cols, suffix: str = "_vec") -> DataFrame:
    """One-hot vectors of categorical columns, all categories kept."""
    for c in cols:
        df = index_column(df, c)
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}{suffix}" for c in cols],
                        dropLast=False, handleInvalid="keep")
    return enc.fit(df).transform(df).drop(*[f"{c}_idx" for c in cols])


def item_onehot(catalog: DataFrame) -> DataFrame:
    """(item_id, item_id_vec): one-hot of each catalog item, fitted on the catalog."""
    return one_hot(catalog.select("item_id").distinct(), ["item_id"])


def vectorize(df: DataFrame, categorical, numeric, out: str = "features", hash_dim: int | None = None) -> DataFrame:
    """Mixed categorical / numeric columns to one sparse vector.

    Exact one-hot by default. With ``hash_dim`` the columns are hashed into a
    fixed-width vector instead, which bounds the model size (FM keeps one
    coefficient vector per feature in a single model) when ids number in the
    hundreds of millions.
    """
    if hash_dim:
        from pyspark.ml.feature import FeatureHasher
        keys = [f"_h_{c}" for c in categorical]
        hasher = FeatureHasher(inputCols=keys, categoricalCols=keys, outputCol="_ids_vec", numFeatures=hash_dim)
        hot = hasher.transform(df.withColumns({k: F.col(c).cast("string") for k, c in zip(keys, categorical)}))
        hot, parts = hot.drop(*keys), ["_ids_vec"]
    else:
        hot, parts = one_hot(df, categorical), [f"{c}_vec" for c in categorical]
    asm = VectorAssembler(inputCols=parts + list(numeric), outputCol=out, handleInvalid="keep")
    return asm.transform(hot).drop(*parts)


def train_gbt(rows: DataFrame, features: list[str] | None = None, **options) -> tuple[Boosted, list[str]]:
    """Boosted trees on labelled rows (M8): ``boosting.fit`` over the numeric columns,
    with the seeded hold-out of ``holdout_split``. The input is written once, so the
    rounds neither recompute nor depend on the feature lineage."""
    features = features or feature_columns(rows)
    keys = [k for k in HOLDOUT_KEYS if k in rows.columns]
    data = holdout_split(rows, keys=keys).select(*features, "label", "is_val", F.xxhash64(*keys).alias("_row_key"))
    return boosting.fit(materialize(data), features, F.col("_row_key"), F.col("is_val"), **options), features


def tree_count(model: Boosted) -> int:
    """Trees that the fit kept."""
    return model.best_round


def holdout_losses(model: Boosted) -> list[float]:
    """Hold-out loss after 0 (the constant base rate), 1, 2, ... trees."""
    return model.losses


def fit_report(spark: SparkSession, model: Boosted) -> DataFrame:
    """(rounds, best_round, holdout_loss, constant_loss) of a fit."""
    return spark.createDataFrame([(model.fitted, model.best_round, model.losses[model.best_round], model.losses[0])],
                                 "rounds bigint, best_round bigint, holdout_loss double, constant_loss double")


def score(model: Boosted, rows: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability."""
    return boosting.score(model, rows, out)


def fm_classify(rows: DataFrame, categorical=("role_id", "item_id"), numeric=(), factor_size: int = MF_RANK,
                max_iter: int = 20, step: float = 0.01, seed: int = 3, hash_dim: int | None = None) -> DataFrame:
    """Factorisation machine over one-hot ids and numeric columns.

    The input is checkpointed once: the encoders' passes and the optimizer's
    iterations then read it instead of re-running the feature lineage."""
    rows = rows.select(*categorical, *numeric, F.col("label").cast("double").alias("label"))
    rows = materialize(rows)
    data = vectorize(rows, list(categorical), list(numeric), hash_dim=hash_dim) \
        .select(*categorical, "label", "features")
    fm = FMClassifier(labelCol="label", featuresCol="features", factorSize=factor_size, maxIter=max_iter,
                      stepSize=step, seed=seed)
    model = fm.fit(data)
    out = model.transform(data).withColumn("score", vector_to_array("probability")[1])
    return out.select(*categorical, "label", "score")
