"""File sources and sinks.

Readers always pass an explicit schema (never inferred), read whole folders
recursively in one scan and keep the source file from ``_metadata``.
Writers are plain DataFrame writers: one folder per output, partitioned by
a column where the method keeps one file per stratum.
"""

from __future__ import annotations

import datetime as _dt
import re
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPACE, strip

SUBMISSIONS_FILE = "reddit_submissions.ndjson"
COMMENTS_FILE = "reddit_comments.ndjson"

SUBMISSION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.LongType()),
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

COMMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.LongType()),
    T.StructField("author", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("removed_by_category", T.StringType()),
])

ISO_TS = "yyyy-MM-dd'T'HH:mm:ssXXX"


def _read_ndjson(spark: SparkSession, base: str, file_name: str, schema: T.StructType) -> DataFrame:
    df = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_name)
        .option("mode", "PERMISSIVE")
        .json(base)
    )
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn("source_block", F.col("_metadata.file_block_start")).withColumn("source_row", F.monotonically_increasing_id())


#: File and line order of records read by ``read_posts`` or ``read_comments``: numbers of a scan grow along a file
#: (within a block of it by row, from block to block by the block's start).
FILE_ORDER = ("source_file", "source_block", "source_row")


def read_posts(spark: SparkSession, base: str, schema: T.StructType = SUBMISSION_SCHEMA, file_name: str = SUBMISSIONS_FILE) -> DataFrame:
    """A1 + F1: every submissions NDJSON below ``base`` in one scan, with its source file."""
    return _read_ndjson(spark, base, file_name, schema)


def read_comments(spark: SparkSession, base: str, schema: T.StructType = COMMENT_SCHEMA, file_name: str = COMMENTS_FILE) -> DataFrame:
    """A2: same for comments."""
    return _read_ndjson(spark, base, file_name, schema)


def append_rows(df: DataFrame, path: str, run: str | None = None) -> int:
    """A5: append rows as NDJSON; returns the number written (counted by an Observation, one pass).

    With ``run``, a name of the job, the rows go to a folder of that name, which the same job
    run again replaces: whatever failed halfway before, no row is there twice.
    """
    from pyspark.sql import Observation

    obs = Observation("append_rows")
    rows = df.observe(obs, F.count(F.lit(1)).alias("n")).write.option("ignoreNullFields", "false")
    if run is None:
        rows.mode("append").json(path)
    else:
        rows.mode("overwrite").json(f"{path}/run={slug_name(run)}")
    return int(obs.get["n"])


def slug_name(name: str) -> str:
    """A folder name: letters, digits, ``.`` and ``-`` stay."""
    out = re.sub(r"[^A-Za-z0-9.\-]+", "_", name)
    if not out.strip("._"):
        raise ValueError(f"no folder name in {name!r}")
    return out


def export_ndjson(df: DataFrame, path: str) -> None:
    """Overwrite as one JSON object per line, non-ASCII kept, ISO timestamps."""
    df.write.mode("overwrite").option("timestampFormat", ISO_TS).option("ignoreNullFields", "false").json(path)


def export_review_table(df: DataFrame, cols, path: str) -> None:
    """Column subset as a CSV review table with a header."""
    df.select(*cols).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def run_provenance(spark: SparkSession, started_at: str, params: dict, counts: dict, cancelled: bool = False,
                   finished_at: str | None = None) -> DataFrame:
    """One-row nested provenance record (start/finish, cancelled, parameters, counts, versions)."""
    import pyspark

    finished_at = finished_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    p = dict(params)
    params_schema = T.StructType([
        T.StructField("subreddits", T.ArrayType(T.StringType())),
        T.StructField("listing", T.StringType()),
        T.StructField("per_subreddit_limit", T.LongType()),
        T.StructField("include_comments", T.BooleanType()),
        T.StructField("comments_limit_per_post", T.LongType()),
        T.StructField("after_utc", T.LongType()),
        T.StructField("before_utc", T.LongType()),
        T.StructField("out_dir", T.StringType()),
    ])
    schema = T.StructType([
        T.StructField("started_at", T.StringType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("cancelled", T.BooleanType()),
        T.StructField("params", params_schema),
        T.StructField("counts", T.StructType([T.StructField("posts", T.LongType()), T.StructField("comments", T.LongType())])),
        T.StructField("versions", T.StructType([T.StructField("python", T.StringType()), T.StructField("spark", T.StringType())])),
    ])
    row = (
        started_at, finished_at, bool(cancelled),
        tuple(p.get(f.name) for f in params_schema.fields),
        (int(counts.get("posts", 0)), int(counts.get("comments", 0))),
        (sys.version.split()[0], pyspark.__version__),
    )
    return spark.createDataFrame([row], schema)


def read_corpus(spark: SparkSession, base: str, pattern: str = "*.txt") -> DataFrame:
    """A10: whole-file texts below ``base``: (path, folder, name, text); top folder = stratum."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(base, wholetext=True)
    path = F.col("_metadata.file_path")
    # names come percent-encoded, below the base as the file system qualifies it
    decoded = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    qualified = _qualified(spark, base)
    rel = F.substring(decoded, len(qualified) + 2, 1 << 20)
    return df.select(
        decoded.alias("path"),
        F.element_at(F.split(rel, "/"), 1).alias("folder"),
        F.regexp_extract(decoded, r"([^/]+)$", 1).alias("name"),
        F.col("value").alias("text"),
    )


def read_corpus_pieces(spark: SparkSession, base: str, pattern: str = "*.txt", piece_bytes: int = 64 << 20) -> DataFrame:
    """A10 for files of any size: (path, folder, name, block, piece, text).

    Splits are planned by bytes (``spark.sql.files.maxPartitionBytes``, small files together,
    large ones cut at line ends).  The lines of a split are put together again while they
    belong to the same file, up to ``piece_bytes``; a file within one split and that bound is
    one row.  Pieces of a file follow each other by block (its byte offset) and piece.
    Bytes that are no UTF-8 are left out; the end of the last line isn't kept.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(base)
    path = F.col("_metadata.file_path")
    decoded = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    lines = df.select(decoded.alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))

    def join(batches):
        at, piece, held, size = None, 0, [], 0

        def row():
            text = b"\n".join(held).decode("utf-8", "ignore")
            return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([piece], pa.int64()), pa.array([text], pa.string())], ["path", "block", "piece", "text"])

        for batch in batches:
            for key, line in zip(zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True), batch.column("line").to_pylist(), strict=True):
                if held and (key != at or size + len(line) > piece_bytes):
                    yield row()
                    piece, held, size = (piece + 1 if key == at else 0), [], 0
                at = key
                held.append(line)
                size += len(line) + 1
        if held:
            yield row()

    pieces = lines.mapInArrow(join, "path string, block long, piece long, text string")
    rel = F.substring("path", len(_qualified(spark, base)) + 2, 1 << 20)
    return pieces.select("path", F.element_at(F.split(rel, "/"), 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "block", "piece", "text")


def _qualified(spark: SparkSession, base: str) -> str:
    """``base`` with the scheme and host of its file system, local ones as ``file:/``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", fs.makeQualified(p).toString().rstrip("/"))


def strip_end(c) -> "F.Column":
    """Text without a final line feed."""
    return F.regexp_replace(c, r"\n$", "")


def export_texts(df: DataFrame, path: str, key: str = "post_id", text_col: str = "selftext", partition_col: str | None = None) -> None:
    """One text per post keyed ``<post_id>_extracted`` (null -> ''), as parquet, not one file per row."""
    out = df.select(F.concat(F.col(key).cast("string"), F.lit("_extracted")).alias("name"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    *([F.col(partition_col)] if partition_col else []))
    w = out.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


#: Bytes of text in one file of ``export_corpus``, unpacked, on average at most.
CORPUS_FILE_BYTES = 16 << 20


def export_corpus(df: DataFrame, path: str, line: Column, folder: str = "part", key: str = "name") -> None:
    """Lines in gzipped text files by folder, for ``read_corpus``: a folder is dealt by ``key`` to as many files as the bytes of all lines need.

    ``line`` is made after the rows are dealt.
    """
    size = df.agg(F.sum(F.octet_length(line).cast("long") + 1)).first()[0] or 0
    n = max(1, -(-size // CORPUS_FILE_BYTES))
    dealt = df.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(n))).repartition(folder, "salt")
    dealt.select(folder, "salt", line.alias("value")).write.partitionBy(folder, "salt").option("compression", "gzip").text(path)


def read_tagged(spark: SparkSession, base: str, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Tab-separated word/tag/lemma lines -> (tokens, rejects).

    strict: exactly three fields are valid, fewer are skipped, more go to rejects;
    otherwise (any whitespace, >= 3 fields) the first three are used.
    """
    df = spark.read.option("recursiveFileLookup", "true").text(base).withColumn("path", F.col("_metadata.file_path"))
    if strict:
        parts = F.split(strip(F.col("value")), "\t")
        x = df.select("path", parts.alias("p"))
        ok = x.filter(F.size("p") == 3)
        rej = x.filter(F.size("p") > 3)
    else:
        parts = F.split(strip(F.col("value")), f"{SPACE}+")
        x = df.select("path", parts.alias("p"))
        ok = x.filter(F.size("p") >= 3)
        rej = x.limit(0)
    tokens = ok.select("path", F.col("p")[0].alias("word"), F.col("p")[1].alias("tag"), F.col("p")[2].alias("lemma"))
    return tokens, rej


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed non-empty lines."""
    return spark.read.text(path).select(strip("value").alias("lemma")).filter(F.col("lemma") != "")


def write_keywords(df: DataFrame, path: str, col: str = "lemma") -> None:
    """Sorted distinct list, one per line, in as many files as the sort has parts (in name order)."""
    df.select(col).distinct().orderBy(col).write.mode("overwrite").text(path)


def read_id_map(spark: SparkSession, path: str, key: str = "id", value: str = "name") -> DataFrame:
    """Two-token lines (key, rest)."""
    p = F.split(strip("value"), f"{SPACE}+", 2)
    return spark.read.text(path).filter(strip("value") != "").select(p[0].alias(key), p[1].alias(value))


def read_matrix(spark: SparkSession, path: str, n_vars: int) -> DataFrame:
    """Space-delimited matrix with a fixed schema; short rows padded with nulls."""
    fields = [T.StructField(c, T.StringType()) for c in ("filename", "prompt", "model", "source")]
    fields += [T.StructField(f"v{i:06d}", T.ByteType()) for i in range(1, n_vars + 1)]
    return spark.read.schema(T.StructType(fields)).option("sep", " ").option("mode", "PERMISSIVE").csv(path)


def export_results(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Tab-separated export with a header."""
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def export_tables(results: dict[str, DataFrame], base: str, sep: str = "\t") -> DataFrame:
    """Several result tables in one job, each in a folder of its name, and a manifest (name, columns, rows) written last.

    The manifest says that the whole set is there; a job run again replaces everything.
    """
    from pyspark.sql import Observation

    if not results:
        raise ValueError("no results to export")
    spark = next(iter(results.values())).sparkSession
    rows = []
    for name, df in results.items():
        seen = Observation()
        export_results(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{base}/{slug_name(name)}", sep)
        rows.append((name, df.columns, int(seen.get["n"])))
    manifest = spark.createDataFrame(rows, "name string, columns array<string>, rows long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/manifest")
    return manifest
