"""Registered I/O and streaming queries: each writes data derived from the driver
tables into a fresh folder under the shared checkpoint directory and reads it
back through the operator under test (A1, A5, A6, A8, A12, A13, K1, K2, D18)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as H
from ..operators import clean as CL
from ..operators import tokens as T
from ..session import checkpoint_dir
from ..sources import files as FI
from ..sources import tables
from ..streaming import collect as ST
from . import sqlfrag as S
from .q_clean import POSTS_SQL
from .registry import register


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/textdims-io/{name}-{uuid.uuid4().hex}"


def _raw_submissions(spark, sf):
    p = tables.posts(spark, sf)
    return p.select(
        F.col("id").cast("string").alias("id"),
        "subreddit",
        F.col("created_utc").cast("double").alias("created_utc"),
        F.lit(None).cast("string").alias("author"),
        F.lit("").alias("title"),
        "selftext",
        F.lit(0).cast("long").alias("score"),
        F.lit(0).cast("long").alias("num_comments"),
        F.lit("").alias("url"),
        F.concat(F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), F.col("id").cast("string")).alias("permalink"),
    )


#: Folders that a task writes to at once; with more it sorts the rest.
FOLDERS = 64
#: Rows of a file that the stream queries collect, about.
FILE_ROWS = 20_000


def _land(spark, sf, path, batches):
    """Writes the submissions as files for ``batches`` micro-batches; how many files each takes in grows with the rows, so that no task gets a whole batch."""
    files = max(1, -(-tables.table(spark, sf, "documents").count() // (batches * FILE_ROWS)))
    _raw_submissions(spark, sf).repartition(batches * files).write.json(path)
    return files


@register(
    "ndjson_roundtrip",
    f"WITH {POSTS_SQL} SELECT CAST(id AS VARCHAR) AS id, subreddit, created_utc, {S.word_count('selftext')} AS n_words FROM posts",
)
def q_ndjson_roundtrip(spark, sf):
    base = _scratch(spark, "ndjson")
    raw = _raw_submissions(spark, sf).withColumn("created_utc", F.col("created_utc").cast("long"))
    # two runs, as two collector folders
    en = F.coalesce(F.col("subreddit") < "src5", F.lit(False))
    FI.append_rows(raw.filter(en), f"{base}/run_a/submissions")
    FI.append_rows(raw.filter(~en), f"{base}/run_b/submissions")
    back = FI.read_posts(spark, base, file_name="part-*.json")
    return back.select("id", "subreddit", "created_utc", H.word_count("selftext").alias("n_words"))


@register(
    "stream_collect",
    f"""WITH {POSTS_SQL} SELECT CAST(id AS VARCHAR) AS id, subreddit, created_utc,
  'https://reddit.com/r/' || subreddit || '/comments/' || CAST(id AS VARCHAR) AS permalink FROM posts""",
)
def q_stream_collect(spark, sf):
    base = _scratch(spark, "stream")
    files = _land(spark, sf, f"{base}/in", 4)
    q = ST.stream_collect(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=files)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out/rows")
    return out.select("id", "subreddit", "created_utc", "permalink")


@register("run_counts", "SELECT CAST(3 AS BIGINT) AS n_batches, count(*) AS n_rows, CAST(1 AS BOOLEAN) AS adds_up FROM documents")
def q_run_counts(spark, sf):
    base = _scratch(spark, "stream")
    files = _land(spark, sf, f"{base}/in", 3)
    ST.stream_collect(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=files).awaitTermination()
    c = ST.run_counts(f"{base}/out", spark)
    return c.agg(F.count(F.lit(1)).alias("n_batches"), F.max("running_rows").alias("n_rows"), (F.sum("rows") == F.max("running_rows")).alias("adds_up"))


@register(
    "stream_first_seen",
    f"""WITH {POSTS_SQL} SELECT DISTINCT CAST(id AS VARCHAR) AS id FROM posts
WHERE selftext IS NOT NULL AND regexp_matches(selftext, '\\S') AND {S.word_count('selftext')} >= 10""",
)
def q_stream_first_seen(spark, sf):
    base = _scratch(spark, "firstseen")
    raw = _raw_submissions(spark, sf)
    raw.write.json(f"{base}/in/part1")
    raw.write.json(f"{base}/in/part2")  # the whole listing replayed after a retry
    stream = spark.readStream.schema(ST.RAW_SUBMISSION_SCHEMA).option("recursiveFileLookup", "true").option("maxBytesPerTrigger", ST.BATCH_BYTES).json(f"{base}/in")
    s = ST.stream_first_seen(stream, dedup_watermark="1000 days")  # replays may come that much later
    q = s.select("id").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register(
    "stream_first_texts",
    f"""WITH {POSTS_SQL} SELECT CAST(min(id) AS VARCHAR) AS id, count(*) AS n FROM posts
WHERE selftext IS NOT NULL AND regexp_matches(selftext, '\\S') AND {S.word_count('selftext')} >= 10 GROUP BY selftext""",
)
def q_stream_first_texts(spark, sf):
    """K2 + D2: equal texts over two runs, the later one bringing the files that come first; n: posts of the text."""
    base = _scratch(spark, "firsttexts")
    raw = _raw_submissions(spark, sf)
    number = F.col("id").cast("long")
    middle = raw.select(F.median(number)).first()[0] or 0
    runs = (("b", number > middle), ("a", number <= middle))  # in the order of their arrival
    for name, part in runs:
        raw.filter(part).repartitionByRange(number).sortWithinPartitions(number).write.json(f"{base}/in/{name}")
        ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/collect", {})
        ST.stream_first_texts(spark, f"{base}/out", f"{base}/first").awaitTermination()
    first = ST.first_texts(spark, f"{base}/out")
    rows = ST.collected(spark, f"{base}/out").select(CL.text_key("selftext").alias("text_key"))
    return first.join(rows, "text_key").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@register(
    "collect_cancel_resume",
    """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, CAST(2 AS BIGINT) AS n_runs, true AS first_cancelled, false AS last_cancelled, CAST(2 AS BIGINT) AS first_batches,
  count(*) AS n_recorded FROM documents""",
)
def q_collect_cancel_resume(spark, sf):
    """K1 + A8: a run that is cancelled after two of four batches, and the run that takes up the rest."""
    base = _scratch(spark, "cancel")
    files = _land(spark, sf, f"{base}/in", 4)
    asked = []

    def stop_at_third():
        asked.append(1)
        return len(asked) > 2

    first = ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", {}, stop_at_third, max_files_per_trigger=files)
    ST.run_collection(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", {}, max_files_per_trigger=files)
    runs = ST.run_records(spark, f"{base}/out")
    return ST.collected(spark, f"{base}/out").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        runs.select(F.count(F.lit(1))).scalar().alias("n_runs"),
        runs.select(F.min_by("cancelled", "started_at")).scalar().alias("first_cancelled"),
        runs.select(F.max_by("cancelled", "started_at")).scalar().alias("last_cancelled"),
        F.lit(len(first)).cast("long").alias("first_batches"),
        runs.select(F.sum("counts.posts")).scalar().alias("n_recorded"),
    )


@register(
    "run_provenance",
    """SELECT false AS cancelled, 'src0' AS subreddit, 'new' AS listing, (SELECT count(*) FROM documents) AS posts,
  (SELECT count(*) FROM conversations WHERE turn > 0) AS comments, true AS timed""",
)
def q_run_provenance(spark, sf):
    import datetime as dt

    started = dt.datetime.now(dt.timezone.utc).isoformat()
    # both counts come from the appends themselves, one pass each
    base = _scratch(spark, "provenance")
    n_posts = FI.append_rows(tables.posts(spark, sf).select("id"), f"{base}/posts")
    n_comments = FI.append_rows(tables.table(spark, sf, "conversations").filter("turn > 0").select("conv_id", "turn"), f"{base}/comments")
    params = {"subreddits": ["src0"], "listing": "new", "per_subreddit_limit": None, "include_comments": True,
              "comments_limit_per_post": None, "after_utc": None, "before_utc": None, "out_dir": "data"}
    p = FI.run_provenance(spark, started, params, {"posts": n_posts, "comments": n_comments})
    return p.select(
        "cancelled", F.col("params.subreddits")[0].alias("subreddit"), "params.listing", "counts.posts", "counts.comments",
        (F.col("finished_at") >= F.col("started_at")).alias("timed"),
    )


@register(
    "comments_roundtrip",
    """SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS id, CAST(conv_id AS VARCHAR) AS post, role AS author, length(text) AS n_chars FROM conversations""",
)
def q_comments_roundtrip(spark, sf):
    """A6 + A2: comments exported as NDJSON, read back through the comment reader."""
    base = _scratch(spark, "comments")
    c = tables.comments(spark, sf)
    FI.export_ndjson(c.select(F.col("id").cast("string").alias("id"), "link_id", "author", "body", "created_utc"), f"{base}/run/comments")
    back = FI.read_comments(spark, base, file_name="part-*.json")
    return back.select("id", F.regexp_replace("link_id", "^t3_", "").alias("post"), "author", F.length("body").cast("long").alias("n_chars"))


@register(
    "corpus_roundtrip",
    f"""SELECT {S.STRATUM} AS folder, count(*) AS n_texts, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY 1""",
)
def q_corpus_roundtrip(spark, sf):
    """A11 + A10: texts exported by folder, written as files of bounded bytes, read back with their folder."""
    base = _scratch(spark, "corpus dir")
    FI.export_texts(tables.texts(spark, sf), f"{base}/parquet", key="text_id", text_col="text", partition_col="folder")
    out = spark.read.parquet(f"{base}/parquet")
    # a text per line for the reader, in folders with a space in their name
    FI.export_corpus(out.select(F.concat(F.lit("sub "), "folder").alias("part"), "name", "text"), f"{base}/texts", F.hex(F.col("text").cast("binary")))
    whole = FI.read_corpus(spark, f"{base}/texts", "*.txt.gz")
    line = whole.select(F.regexp_replace("folder", "^part=sub ", "").alias("folder"), F.explode(F.split(FI.strip_end("text"), "\n")).alias("line"))
    text = F.unhex("line").cast("string")
    return line.groupBy("folder").agg(F.count(F.lit(1)).alias("n_texts"), F.sum(F.length(text)).alias("n_chars"))


@register("id_map_roundtrip", "SELECT CAST(doc_id AS VARCHAR) AS id, 'name of ' || CAST(n_chars AS VARCHAR) AS name FROM documents")
def q_id_map_roundtrip(spark, sf):
    """Two-token lines, the second with spaces of its own."""
    path = _scratch(spark, "ids")
    d = tables.table(spark, sf, "documents")
    d.select(F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit("\t name of "), F.col("n_chars").cast("string")).alias("value")).write.text(path)
    return FI.read_id_map(spark, path)


@register(
    "matrix_roundtrip",
    """SELECT doc_id AS text_id, CAST(doc_id % 2 AS INTEGER) AS a, CAST(CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS b FROM documents""",
)
def q_matrix_roundtrip(spark, sf):
    """Space-delimited matrix lines."""
    path = _scratch(spark, "matrix")
    d = tables.table(spark, sf, "documents")
    cells = [F.col("doc_id").cast("string"), F.lit("generic"), F.lit("gpt"), F.lit("ai"), (F.col("doc_id") % 2).cast("string"), (F.col("n_chars") % 3 == 0).cast("int").cast("string")]
    d.select(F.concat_ws(" ", *cells).alias("value")).write.text(path)
    m = FI.read_matrix(spark, path, 2)
    return m.select(F.col("filename").cast("long").alias("text_id"), F.col("v000001").cast("int").alias("a"), F.col("v000002").cast("int").alias("b"))


@register(
    "results_roundtrip",
    "SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL",
)
def q_results_roundtrip(spark, sf):
    """Tab-separated results with a header."""
    path = _scratch(spark, "results")
    FI.export_results(tables.table(spark, sf, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.option("header", "true").option("sep", "\t").schema("source string, lang string, n long").csv(path)


@register(
    "tagged_roundtrip",
    f"""WITH toks AS (SELECT {S.STRATUM} AS folder, unnest(regexp_extract_all(text, {S.q(T.TOKEN_PATTERN)})) AS word FROM documents),
t AS (SELECT folder, word, {S.tag('word')} AS tag FROM toks),
l AS (SELECT folder, word, tag, {S.lemma('word', 'tag')} AS lemma FROM t)
SELECT folder, tag, count(*) AS n FROM l GROUP BY ALL""",
)
def q_tagged_roundtrip(spark, sf):
    base = _scratch(spark, "tagged")
    t = tables.texts(spark, sf).select("text_id", F.col("stratum").alias("folder"), "text")
    tk = T.tag_tokens(t, keys=("text_id", "folder"))
    # a task keeps the files of its folders open, so that the tokens need no sort by folder
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, FOLDERS)
    try:
        tk.select("folder", F.concat_ws("\t", "word", "tag", "lemma").alias("value")).write.partitionBy("folder").text(base)
    finally:
        spark.conf.set(name, before)
    toks, _ = FI.read_tagged(spark, base)
    folder = F.regexp_extract(F.col("path"), r"folder=([^/]+)/", 1)
    return toks.groupBy(folder.alias("folder"), "tag").agg(F.count(F.lit(1)).alias("n"))
