"""File readers and writers.

* headerless delimited files with supplied names and types (S1)
* CSV with a header and a saved row index, the index dropped (S2)
* single-column catalog files (S3)
* data files whose names come from a sidecar file, last five dropped (S4)
* one dataset per day: written once partitioned by day, read back with
  partition pruning instead of one file per day (S5, S8)
* writers (S7) and model persistence (S9)

Scratch outputs go under the session's checkpoint folder, which a cluster
points at shared storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.dates import to_day
from cartwise.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/cartwise-scratch/{name}-{uuid.uuid4().hex[:12]}"


def schema_of(names, types: dict | None = None, default: str = "string") -> str:
    """DDL schema string for the supplied names; unlisted columns get ``default``."""
    types = types or {}
    return ", ".join(f"`{n}` {types.get(n, default)}" for n in names)


def read_delimited(spark: SparkSession, path: str, names, types: dict | None = None, sep: str = "\t",
                   header: bool = False) -> DataFrame:
    """Headerless (or headed) delimited text with a fixed schema; no inference."""
    schema = schema_of(names, types)
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


def read_indexed_csv(spark: SparkSession, path: str, names, types: dict | None = None) -> DataFrame:
    """CSV with a header whose first column is a saved row index; the index is dropped."""
    schema = schema_of(["_index"] + list(names), types)
    return spark.read.schema(schema).option("header", True).csv(path).drop("_index")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One ``item_id`` per line (S3)."""
    return read_delimited(spark, path, ["item_id"], {"item_id": "bigint"})


def read_names(spark: SparkSession, names_path: str, drop_last: int = 5) -> list[str]:
    """Column names from a sidecar file: first field of each line, stripped, last
    ``drop_last`` dropped (S4). The file has one line per column: a bounded list."""
    lines = spark.read.text(names_path).select(F.trim(F.split("value", "\t")[0]).alias("n")).collect()
    names = [r["n"] for r in lines]
    return names[:-drop_last] if drop_last else names


def read_with_sidecar(spark: SparkSession, data_path: str, names_path: str, drop_last: int = 5,
                      types: dict | None = None, sep: str = "\t") -> DataFrame:
    return read_delimited(spark, data_path, read_names(spark, names_path, drop_last), types, sep)


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False) -> str:
    """Text sink."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)
    return path


def write_by_day(df: DataFrame, path: str, day: str = "dt") -> str:
    """One dataset partitioned by day instead of one file per day."""
    df.write.mode("overwrite").partitionBy(day).parquet(path)
    return path


def read_day(spark: SparkSession, path: str, day, day_col: str = "dt") -> DataFrame:
    """The slice of one day; the partition filter prunes the other folders."""
    return spark.read.parquet(path).where(F.col(day_col) == F.lit(to_day(day)))


def save_model(model, path: str) -> str:
    """Spark ML persistence in place of a pickle."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
