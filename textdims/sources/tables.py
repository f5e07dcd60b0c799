"""Parquet inputs and the adapters from the driver tables to the logical tables.

The logical tables of the method are posts / comments / listings / texts /
group scores.  The adapters below are pure projections, so Catalyst prunes
columns and pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed adapter constants (identical in the SQL oracles).
POST_EPOCH_BASE = 1704067200  # 2024-01-01T00:00:00Z
POST_EPOCH_STEP = 3600  # one post per hour of doc_id
COMMENT_ID_FACTOR = 1000
# language -> sub-corpus folder (plays the human / model-written strata)
FOLDER_OF_LANG = {"en": "human", "de": "generic_gpt", "es": "summary_guided_gpt", "fr": "generic_qwen"}


#: Bytes of a table from which it pays to deal it over the cores.
SPREAD_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A Parquet table whose row groups are fewer than the cores, dealt over them; any other as it is.

    A row group is read by one task however many there are to take it, so a small table in one or
    two of them would leave the other cores idle through all the text work.  What is shuffled is
    bounded by the cores' number of row groups; a large table is never touched.
    """
    spark = df.sparkSession
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if not 0 < len(files) < cores:
        return df
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    groups = size = 0
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            for group in reader.getRowGroups():
                groups, size = groups + 1, size + group.getTotalByteSize()
        finally:
            reader.close()
    return df.repartition(2 * cores) if groups < cores and size >= SPREAD_BYTES else df


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> posts (id, subreddit, selftext, language, created_utc)."""
    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("subreddit"),
        F.col("text").alias("selftext"),
        F.col("lang").alias("language"),
        (F.lit(POST_EPOCH_BASE) + F.col("doc_id") * POST_EPOCH_STEP).alias("created_utc"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> texts; the folder (sub-corpus) is the stratum."""
    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        F.col("doc_id").alias("text_id"),
        folder_of(F.col("lang")).alias("stratum"),
        F.col("source").alias("source"),
        folder_of(F.col("lang")).alias("folder"),
        F.col("text"),
    )


def folder_of(lang):
    e = F.when(F.lit(False), F.lit(None))
    for k, v in FOLDER_OF_LANG.items():
        e = e.when(lang == k, F.lit(v))
    return e.otherwise(F.concat(F.lit("other_"), F.coalesce(lang, F.lit("unknown"))))


def folder_sql(col: str = "lang") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in FOLDER_OF_LANG.items())
    return f"(CASE {whens} ELSE 'other_' || coalesce({col}, 'unknown') END)"


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> raw comment records (turn 0 plays the post)."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * COMMENT_ID_FACTOR + F.col("turn")).alias("id"),
        F.concat(F.lit("t3_"), F.col("conv_id").cast("string")).alias("link_id"),
        F.col("conv_id"),
        F.col("turn"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        (F.lit(POST_EPOCH_BASE) + F.col("conv_id") * POST_EPOCH_STEP + F.col("turn")).alias("created_utc"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> listing items (subreddit = event_type, created_utc = epoch(ts), score = value)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("subreddit"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"),
        F.col("value").alias("score"),
        F.col("user_id"),
    )


def group_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> (level columns, numeric dimensions) for group comparison."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
    )
