"""What the operators of this subpackage share: text columns, Arrow batches, folds, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows and bytes of one Arrow batch, so that a Python worker holds a few MB of text at a time.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The two columns an operator reads (and ``more``); a null text is empty. Other columns never reach it."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def text_key(text: Column) -> Column:
    """Tells rows that share an id apart by their texts."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows whose id and text are in ``gone`` (doc_id, key)."""
    left = gone.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    same = docs[id_col].cast("long").eqNullSafe(left["__id"]) & (text_key(docs[text_col]) == left["__key"])
    return docs.join(left, same, "left_anti")


def one_of_repeats(docs: DataFrame, repeats: DataFrame, same: Column) -> DataFrame:
    """The rows of ``docs`` that match ``repeats`` (__id, __key; each once) by ``same``, one row of each match.

    The rows are numbered in a written table, so that the choice is the same whenever it is read.
    """
    rows = cut(docs.join(repeats, same).withColumn("__row", F.monotonically_increasing_id()))
    first = rows.groupBy("__id", "__key").agg(F.min("__row").alias("__row")).select("__row")
    return rows.join(first, "__row", "left_semi").drop("__id", "__key", "__row")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in rows and bytes unless the session says otherwise."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) in (None, "10000", str(2**31 - 1), str(2**63 - 1), "64MB", "256MB"):
            spark.conf.set(key, str(value))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over bounded batches."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def unit_hash(seed: int, *cols: Column) -> Column:
    """A value in [0, 1) that only depends on ``cols``: keeps a fixed share of the rows of any size."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array without nulls, without copying the text."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]
