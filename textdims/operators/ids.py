"""Sequential ids over a total order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequential_ids(df: DataFrame, order_cols, out: str = "seq", start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = position in the total order of ``order_cols`` (+ start).

    Range-partition + sort within partitions; per-partition row counts (one
    row per partition, a proven bound) give offsets; a row's id is offset +
    position inside its partition.  ``order_cols`` must be a unique key so the
    order is total; positions are materialised once so every consumer (and a
    recomputation after executor loss) sees the same numbering.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    pos = ranged.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__ppos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    )
    # the positions are written once: recomputing the range sort could sample
    # other boundaries (shuffle fetch order is not deterministic)
    from ..session import materialize

    pos = materialize(pos, "seq-ids")
    counts = pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("__off"))
    return (
        pos.join(F.broadcast(offsets), "__pid")
        .withColumn(out, F.lit(start) + F.col("__off") + F.col("__ppos"))
        .drop("__pid", "__ppos", "__off")
    )


def formatted_ids(df: DataFrame, order_cols, out: str, prefix: str, width: int, start: int = 0) -> DataFrame:
    """``prefix`` + zero-padded sequential number, e.g. hrp000000, t000001."""
    s = sequential_ids(df, order_cols, out="_seq", start=start)
    return s.withColumn(out, F.concat(F.lit(prefix), F.lpad(F.col("_seq").cast("string"), width, "0"))).drop("_seq")
