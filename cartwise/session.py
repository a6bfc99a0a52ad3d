"""Spark session helpers."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "cartwise", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, which all executors must share.

    ``spark.checkpoint.dir`` is used as it is. Where it is unset the tables go
    below the configured warehouse (``spark.sql.warehouse.dir``), which a cluster
    shares as well, and the choice is logged. Never a temp folder of one machine.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_cartwise"
            logging.getLogger("cartwise").warning("spark.checkpoint.dir is not set; using %s", folder)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df):
    """Write ``df`` once as a parquet table under the shared checkpoint folder and
    read it back.

    This cuts the lineage (later passes, and retries after a lost executor,
    read the files instead of recomputing), computes the input exactly once
    (``Dataset.checkpoint`` computes it twice unless cached), and keeps the data
    columnar, so readers prune columns. It always writes, so the cost model is
    the same in every session.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwise-materialized/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
