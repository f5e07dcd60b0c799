"""Structured Streaming collection.

``stream_collect`` reads NDJSON records as they land (explicit schema),
normalises them (A3/A4) and appends each micro-batch to the output folder
through ``foreachBatch`` with a checkpoint.  A batch has a folder of its own
(``batch_id=<n>``) and overwrites it, so a batch that is run again after a
failure leaves no row twice; its count (an observation on the one pass that
writes it) is kept as a provenance row.  Rows keep the file and line they came from.

``run_collection`` is one run of it from start to end: the stop flag is read before each
batch (a batch is written whole or not at all), progress is told by a query
listener, and one provenance record closes the run, also a cancelled one.  The next run goes on
where the last one ended.

``stream_first_seen`` is the incremental form of the cleaning head: blank
and short posts dropped, replayed ids dropped.  Exact de-duplication keeps
every seen id in the state store (state grows with distinct ids); with
``dedup_watermark`` the state is bounded by arrival instead
(``dropDuplicatesWithinWatermark`` on the time of the micro-batch), which is
exact for replays that arrive within that delay.  The time of a post plays no
part, so a post is never late however old it is and whatever the order of the files.

``stream_first_texts`` drops equal texts across batches and restarts, by D2's rule: the
first by file and line stays, whenever it arrives.  Its state, kept on disk by
the RocksDB store, is a digest and a place for each different text; every batch writes
the texts whose first place is new or has moved up, and ``first_texts`` reads the least of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..functions import text as H
from ..operators.clean import text_key
from ..operators.listing import normalize_comment, normalize_submission
from ..sources.files import FILE_ORDER, run_provenance

RAW_SUBMISSION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("author", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("over_18", T.BooleanType()),
    T.StructField("removed_by_category", T.StringType()),
])


#: Bytes of files that one micro-batch takes in.
BATCH_BYTES = 1 << 30
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Cancelled(Exception):
    """The stop flag was set before a batch."""


def stream_collect(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, kind: str = "submission",
                   schema: T.StructType = RAW_SUBMISSION_SCHEMA, max_files_per_trigger: int | None = None,
                   available_now: bool = True, should_cancel: Callable[[], bool] | None = None, written: dict[int, int] | None = None):
    """K1: start the collection stream; returns the StreamingQuery (``awaitTermination`` to finish).

    ``written`` takes the rows of each batch of this run.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", BATCH_BYTES)
    raw = reader.json(in_dir)
    place = (F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"))
    norm = normalize_submission(raw, *place) if kind == "submission" else normalize_comment(raw, *place)

    w = norm.writeStream.foreachBatch(batch_writer(out_dir, should_cancel, written)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def batch_writer(out_dir: str, should_cancel: Callable[[], bool] | None = None, written: dict[int, int] | None = None):
    """Writes a micro-batch and its count; the same batch number replaces what it wrote before."""

    def write_batch(batch: DataFrame, epoch_id: int):
        if should_cancel is not None and should_cancel():
            raise Cancelled(f"before batch {epoch_id}")
        seen = Observation()
        rows = batch.withColumn("source_row", F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").parquet(f"{out_dir}/rows/batch_id={epoch_id}")
        n = int(seen.get["rows"])
        counts = batch.sparkSession.createDataFrame([(n,)], "rows long")
        counts.write.mode("overwrite").parquet(f"{out_dir}/provenance/batch_id={epoch_id}")
        if written is not None:
            written[epoch_id] = n

    return write_batch


class _Progress(StreamingQueryListener):
    """Tells the progress of one query's batches."""

    def __init__(self, tell: Callable[[str], None]):
        self.tell, self.run = tell, None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if self.run in (None, str(event.progress.runId)):
            self.tell(f"batch {event.progress.batchId}: {event.progress.numInputRows} rows")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_collection(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, params: dict, should_cancel: Callable[[], bool] | None = None,
                   progress: Callable[[str], None] | None = None, kind: str = "submission", **options) -> dict[int, int]:
    """K1 + A8: collect what has landed, then append one provenance record to ``out_dir``/logs; returns the rows of each batch.

    ``should_cancel`` is read before every batch; when it says so, the run ends there and its
    record says cancelled.  Another run with the same checkpoint takes up the batches left.
    """
    started = dt.datetime.now(dt.timezone.utc).isoformat()
    written: dict[int, int] = {}
    listener = _Progress(progress) if progress else None
    if listener:
        spark.streams.addListener(listener)
    cancelled = False

    def stop() -> bool:
        nonlocal cancelled
        cancelled = should_cancel is not None and bool(should_cancel())
        return cancelled

    try:
        query = stream_collect(spark, in_dir, out_dir, checkpoint, kind, should_cancel=stop, written=written, **options)
        if listener:
            listener.run = str(query.runId)
        query.awaitTermination()
    except StreamingQueryException:
        if not cancelled:
            raise
    finally:
        if listener:
            spark.streams.removeListener(listener)
    posts, comments = (sum(written.values()), 0) if kind == "submission" else (0, sum(written.values()))
    record = run_provenance(spark, started, {"out_dir": out_dir, **params}, {"posts": posts, "comments": comments}, cancelled)
    record.coalesce(1).write.mode("append").json(f"{out_dir}/logs")
    if progress:
        progress("Collection cancelled." if cancelled else "Collection finished.")
    return written


def run_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """The provenance records of all runs."""
    return spark.read.json(f"{out_dir}/logs")


def collected(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows of all batches, with the file and line they came from."""
    return spark.read.parquet(f"{out_dir}/rows")


def stream_first_texts(spark: SparkSession, out_dir: str, checkpoint: str, text_col: str = "selftext", min_words: int = 10, id_col: str = "id"):
    """K2 + D2: start the stream over ``stream_collect``'s rows that keeps the first of equal texts; returns the StreamingQuery.

    Blank and short posts are dropped first.  Results are read by ``first_texts``.
    """
    rows = spark.read.parquet(f"{out_dir}/rows")
    stream = spark.readStream.schema(rows.drop("batch_id").schema).option("recursiveFileLookup", "true").option("maxBytesPerTrigger", BATCH_BYTES).parquet(f"{out_dir}/rows")
    long = stream.filter(~H.is_blank(text_col)).filter(H.word_count(text_col) >= min_words)
    first = long.groupBy(text_key(text_col).alias("text_key")).agg(F.min(F.struct(*FILE_ORDER, F.col(id_col).alias("id"))).alias("first"))

    def write_batch(batch: DataFrame, epoch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_dir}/first/batch_id={epoch_id}")

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)  # the query takes it over when it starts
    try:
        return first.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def first_texts(spark: SparkSession, out_dir: str) -> DataFrame:
    """K2: (text_key, id, source_file, source_block, source_row): the first of each different text so far."""
    first = spark.read.parquet(f"{out_dir}/first").groupBy("text_key").agg(F.min("first").alias("first"))
    return first.select("text_key", "first.*")


def stream_first_seen(df: DataFrame, text_col: str = "selftext", min_words: int = 10, id_col: str = "id",
                      dedup_watermark: str | None = None) -> DataFrame:
    """K2: drop blank and short posts and replayed ids in a stream; ``dedup_watermark``: the longest interval between a post and its replay."""
    s = df.filter(~H.is_blank(text_col)).filter(H.word_count(text_col) >= min_words)
    if dedup_watermark:
        # in a stream this is the time of the micro-batch, the same when a batch is run again
        s = s.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", dedup_watermark)
        return s.dropDuplicatesWithinWatermark([id_col]).drop("_arrived")
    return s.dropDuplicates([id_col])


def run_counts(out_dir: str, spark: SparkSession) -> DataFrame:
    """Running totals of rows appended, per micro-batch."""
    from pyspark.sql import Window

    p = spark.read.parquet(f"{out_dir}/provenance").select(F.col("batch_id").cast("long").alias("batch_id"), "rows")
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return p.withColumn("running_rows", F.sum("rows").over(w))
