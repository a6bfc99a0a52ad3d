"""Helpers the operators share: tables, written stages, words of long texts."""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwise-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    passes and retries after a lost executor read files, not the lineage."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value) -> Broadcast:
    """``value`` broadcast with its classes by value: a plain broadcast names them by
    module, which executors without this package cannot import."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast: Broadcast):
    """The value of ``sent``, in a task."""
    return pickle.loads(broadcast.value)


def text_key(column: str):
    """A 64-bit key of a text. With the id it names a row: rows equal in both are repeats."""
    return F.xxhash64(F.col(column))


def named_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, i, k): each row as one struct beside its id and text key, so that no column
    of ``df`` can clash with a helper's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("i"),
                     text_key(text_col).alias("k"))


def without(df: DataFrame, bad: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` without the rows named by ``bad`` (id, key). Each row is judged by its own
    text, also where ids are null or repeated."""
    bad = bad.select(F.col("id").alias("bad_id"), F.col("key").alias("bad_key")).distinct()
    return named_rows(df, id_col, text_col).join(
        bad, F.col("i").eqNullSafe(F.col("bad_id")) & (F.col("k") == F.col("bad_key")), "left_anti").select("row.*")


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts (one aggregate row), the figure block counts are set from."""
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_values(column):
    """The values of a string column as bytes (None for null), one at a time."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    for value in column.cast(pa.large_binary()):
        yield value.as_py()


#: ASCII white space, the separators of a word ``[^\x20\x09-\x0D]+``.
SPACES = b" \t\n\x0b\x0c\r"


def pieces(text: bytes, size: int = 1 << 22):
    """``text`` cut at white space into parts of about ``size`` bytes, so that the
    word list of a very long text is never held as a whole."""
    start, end = 0, len(text)
    while end - start > size:
        cut = start + size
        while cut < end and text[cut] not in SPACES:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:end]


def word_lists(text: bytes | None):
    """Lists of the words of ``text``, in order. ``bytes.split`` splits at exactly
    the six ASCII white-space bytes."""
    for part in pieces(text or b""):
        words = part.split()
        if words:
            yield words


def slices(batch, column: str, size: int = 1 << 20):
    """Row ranges of ``batch`` of about ``size`` bytes of ``column`` each."""
    values = batch.column(column)
    if len(values) == 0:
        return
    lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
    edges = [0, *cuts.tolist(), len(values)]
    for s, e in zip(edges, edges[1:]):
        if e > s:
            yield batch.slice(s, e - s)


def record_batches(schema: pa.Schema, columns: list, rows: int = 1 << 16):
    """Arrow batches of at most ``rows`` rows of the given arrays."""
    whole = pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
    yield from whole.to_batches(max_chunksize=rows)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finishing mix of 64-bit values (xor-shift and odd multipliers)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
