"""Registered cleaning / listing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as H
from ..operators import clean as C
from ..operators import ids as I
from ..operators import listing as L
from ..session import materialize
from ..sources import tables
from . import sqlfrag as S
from .registry import register

MIN_WORDS = 10
TERMS = ("nicht", "avec", "with")
TARGET_LANG = "en"
DROPPED_GROUPS = ("src0", "src1")
LOOKUP_ID = 42
LISTING_N = 100
AFTER_UTC = 1704153600  # 2024-01-02T00:00:00Z
BEFORE_UTC = 1705708800  # 2024-01-20T00:00:00Z
COMMENT_CAP = 2

POSTS_SQL = f"""posts AS (
  SELECT doc_id AS id, source AS subreddit, text AS selftext, lang AS language,
         CAST({tables.POST_EPOCH_BASE} + doc_id * {tables.POST_EPOCH_STEP} AS BIGINT) AS created_utc
  FROM documents
)"""
WC = S.word_count("selftext")
NOT_BLANK = "selftext IS NOT NULL AND regexp_matches(selftext, '\\S')"


def preview_sql(col, n):
    return f"substr(regexp_replace({col}, '\\s+', ' ', 'g'), 1, {n})"


def _posts(spark, sf):
    return tables.posts(spark, sf)


@register("word_count", f"WITH {POSTS_SQL} SELECT id, {WC} AS n_words FROM posts")
def q_word_count(spark, sf):
    return _posts(spark, sf).select("id", H.word_count("selftext").alias("n_words"))


@register(
    "drop_blank_min_words",
    f"WITH {POSTS_SQL} SELECT id, {WC} AS n_words FROM posts WHERE {NOT_BLANK} AND {WC} >= {MIN_WORDS}",
)
def q_drop_blank_min_words(spark, sf):
    p = C.min_words(C.drop_blank(_posts(spark, sf), "selftext"), "selftext", MIN_WORDS)
    return p.select("id", H.word_count("selftext").alias("n_words"))


@register(
    "min_words_report",
    f"""WITH {POSTS_SQL}, b AS (SELECT * FROM posts WHERE {NOT_BLANK})
SELECT count(*) AS n_total, CAST(coalesce(sum(CASE WHEN {WC} < {MIN_WORDS} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_below,
       round(CASE WHEN count(*) > 0 THEN coalesce(sum(CASE WHEN {WC} < {MIN_WORDS} THEN 1 ELSE 0 END), 0) / count(*) ELSE 0.0 END, 6) AS share_below
FROM b""",
)
def q_min_words_report(spark, sf):
    return C.min_words_report(C.drop_blank(_posts(spark, sf), "selftext"), "selftext", MIN_WORDS)


@register(
    "duplicate_report",
    f"""WITH {POSTS_SQL}, c AS (SELECT selftext, count(*) AS text_count FROM posts GROUP BY selftext HAVING count(*) > 1)
SELECT p.id, p.subreddit, c.text_count FROM posts p JOIN c ON p.selftext = c.selftext""",
)
def q_duplicate_report(spark, sf):
    return C.duplicate_report(_posts(spark, sf), "selftext").select("id", "subreddit", "text_count")


@register(
    "exact_dedup",
    f"""WITH {POSTS_SQL}
SELECT id, subreddit FROM posts WHERE id IN (SELECT min(id) FROM posts GROUP BY selftext)""",
)
def q_exact_dedup(spark, sf):
    return C.exact_dedup(_posts(spark, sf), "selftext", ("id",)).select("id", "subreddit")


@register(
    "distinct_count",
    f"""WITH {POSTS_SQL}, d AS (SELECT * FROM posts WHERE id IN (SELECT min(id) FROM posts GROUP BY selftext))
SELECT (SELECT count(*) FROM posts) AS n_rows, (SELECT count(DISTINCT selftext) FROM posts) AS n_distinct,
       (SELECT count(*) FROM d) AS n_rows_after, (SELECT count(DISTINCT selftext) FROM d) AS n_distinct_after""",
)
def q_distinct_count(spark, sf):
    p = _posts(spark, sf)
    before = C.distinct_count(p, "selftext")
    after = C.distinct_count(C.exact_dedup(p, "selftext"), "selftext")
    a = after.select(F.struct("n_rows", "n_distinct")).scalar()
    return before.select("n_rows", "n_distinct", a["n_rows"].alias("n_rows_after"), a["n_distinct"].alias("n_distinct_after"))


_TERMS_SQL = ", ".join(S.q(t) for t in TERMS)


@register(
    "match_terms",
    f"""WITH {POSTS_SQL}, m AS (
  SELECT id, subreddit, selftext,
         list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(selftext, {S.WORD}), lambda x: lower(x)), lambda x: x IN ({_TERMS_SQL})))) AS mt
  FROM posts)
SELECT id, subreddit, array_to_string(mt, ',') AS matched_terms, {preview_sql('selftext', 300)} AS preview FROM m WHERE len(mt) > 0""",
)
def q_match_terms(spark, sf):
    m = C.match_terms(_posts(spark, sf), "selftext", TERMS, 300)
    return m.select("id", "subreddit", F.array_join("matched_terms", ",").alias("matched_terms"), "preview")


@register(
    "match_share",
    f"""WITH {POSTS_SQL}, m AS (
  SELECT len(list_filter(regexp_extract_all(selftext, {S.WORD}), lambda x: lower(x) IN ({_TERMS_SQL}))) > 0 AS hit FROM posts)
SELECT count(*) AS n_total, CAST(coalesce(sum(CASE WHEN hit THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_match,
       round(coalesce(sum(CASE WHEN hit THEN 1 ELSE 0 END), 0) / count(*), 6) AS share FROM m""",
)
def q_match_share(spark, sf):
    return C.match_share(_posts(spark, sf), "selftext", TERMS)


@register("preview", f"WITH {POSTS_SQL} SELECT id, {preview_sql('selftext', 300)} AS preview FROM posts")
def q_preview(spark, sf):
    return _posts(spark, sf).select("id", H.preview("selftext", 300).alias("preview"))


@register(
    "drop_ids",
    f"WITH {POSTS_SQL} SELECT id, subreddit FROM posts WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def q_drop_ids(spark, sf):
    ids = tables.table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    return C.drop_ids(_posts(spark, sf), ids).select("id", "subreddit")


@register(
    "drop_ids_report",
    f"""WITH {POSTS_SQL}, kept AS (SELECT * FROM posts WHERE {WC} >= {MIN_WORDS}),
req AS (SELECT DISTINCT doc_id AS id FROM labels WHERE toxic = 1)
SELECT (SELECT count(*) FROM req) AS requested,
       (SELECT count(*) FROM req WHERE id IN (SELECT id FROM kept)) AS found,
       (SELECT count(*) FROM req WHERE id NOT IN (SELECT id FROM kept)) AS missing""",
)
def q_drop_ids_report(spark, sf):
    ids = tables.table(spark, sf, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    kept = C.min_words(_posts(spark, sf), "selftext", MIN_WORDS)
    return C.drop_ids_report(kept, ids)


@register(
    "keep_language",
    f"""WITH {POSTS_SQL}
SELECT id, language FROM posts
WHERE coalesce(language, 'unknown') = '{TARGET_LANG}' OR id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def q_keep_language(spark, sf):
    allow = tables.table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))
    return C.keep_language(_posts(spark, sf), TARGET_LANG, allow).select("id", "language")


@register(
    "non_target_language",
    f"""WITH {POSTS_SQL}
SELECT id, coalesce(language, 'unknown') AS language, subreddit, {preview_sql('selftext', 400)} AS preview
FROM posts WHERE coalesce(language, 'unknown') <> '{TARGET_LANG}'""",
)
def q_non_target_language(spark, sf):
    return C.non_target_language(_posts(spark, sf), TARGET_LANG, "selftext").select("id", "language", "subreddit", "preview")


@register(
    "drop_groups",
    f"WITH {POSTS_SQL} SELECT id, subreddit FROM posts WHERE subreddit IS NULL OR subreddit NOT IN ({', '.join(S.q(g) for g in DROPPED_GROUPS)})",
)
def q_drop_groups(spark, sf):
    return C.drop_groups(_posts(spark, sf), "subreddit", DROPPED_GROUPS).select("id", "subreddit")


@register("lookup_id", f"WITH {POSTS_SQL} SELECT id, subreddit, language, {WC} AS n_words FROM posts WHERE id = {LOOKUP_ID}")
def q_lookup_id(spark, sf):
    return C.lookup_id(_posts(spark, sf), LOOKUP_ID).select("id", "subreddit", "language", H.word_count("selftext").alias("n_words"))


LISTING_SQL = """listing AS (
  SELECT event_id AS id, event_type AS subreddit, CAST(floor(epoch(ts)) AS BIGINT) AS created_utc, value AS score FROM events
)"""


@register(
    "listing_limit",
    f"""WITH {LISTING_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id) AS rn FROM listing)
SELECT id, subreddit, created_utc, score FROM r WHERE rn <= {LISTING_N}""",
)
def q_listing_limit(spark, sf):
    return L.listing_limit(tables.listing(spark, sf), LISTING_N, "top").select("id", "subreddit", "created_utc", "score")


@register(
    "time_window",
    f"""WITH {LISTING_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) AS rn FROM listing)
SELECT id, subreddit, created_utc FROM r WHERE rn <= {LISTING_N * 10} AND created_utc >= {AFTER_UTC} AND created_utc <= {BEFORE_UTC}""",
)
def q_time_window(spark, sf):
    lim = L.listing_limit(tables.listing(spark, sf), LISTING_N * 10, "new")
    return C.time_window(lim, AFTER_UTC, BEFORE_UTC).select("id", "subreddit", "created_utc")


COMMENTS_SQL = f"""raw_comments AS (
  SELECT CAST(conv_id * {tables.COMMENT_ID_FACTOR} + turn AS BIGINT) AS id, 't3_' || CAST(conv_id AS VARCHAR) AS link_id,
         conv_id, turn, role AS author, text AS body,
         CAST({tables.POST_EPOCH_BASE} + conv_id * {tables.POST_EPOCH_STEP} + turn AS BIGINT) AS created_utc
  FROM conversations
)"""


def _norm_comments(spark, sf):
    raw = tables.comments(spark, sf)
    return L.normalize_comment(raw.withColumn("permalink", F.concat(F.lit("/c/"), F.col("id").cast("string"))))


@register(
    "normalize_comment",
    f"""WITH {COMMENTS_SQL}
SELECT CAST(id AS VARCHAR) AS id, replace(link_id, 't3_', '') AS link_id, created_utc, author,
       'https://reddit.com/c/' || CAST(id AS VARCHAR) AS permalink FROM raw_comments""",
)
def q_normalize_comment(spark, sf):
    return _norm_comments(spark, sf).select("id", "link_id", "created_utc", "author", "permalink")


@register(
    "cap_comments",
    f"""WITH {COMMENTS_SQL}, c AS (SELECT * FROM raw_comments WHERE turn > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY replace(link_id, 't3_', '') ORDER BY created_utc, CAST(id AS VARCHAR)) AS rn FROM c)
SELECT CAST(id AS VARCHAR) AS id, replace(link_id, 't3_', '') AS link_id FROM r WHERE rn <= {COMMENT_CAP}""",
)
def q_cap_comments(spark, sf):
    c = _norm_comments(spark, sf).filter(F.col("id").cast("long") % tables.COMMENT_ID_FACTOR > 0)
    return L.cap_comments(c, COMMENT_CAP).select("id", "link_id")


@register(
    "comments_of_posts",
    f"""WITH {COMMENTS_SQL},
p AS (SELECT CAST(conv_id AS VARCHAR) AS pid FROM raw_comments WHERE turn = 0 AND {S.word_count('body')} >= {MIN_WORDS}),
c AS (SELECT * FROM raw_comments WHERE turn > 0 AND replace(link_id, 't3_', '') IN (SELECT pid FROM p)),
r AS (SELECT *, row_number() OVER (PARTITION BY replace(link_id, 't3_', '') ORDER BY created_utc, CAST(id AS VARCHAR)) AS rn FROM c)
SELECT CAST(id AS VARCHAR) AS id, replace(link_id, 't3_', '') AS link_id, author FROM r WHERE rn <= {COMMENT_CAP + 1}""",
)
def q_comments_of_posts(spark, sf):
    allc = _norm_comments(spark, sf)
    turn = F.col("id").cast("long") % tables.COMMENT_ID_FACTOR
    posts = C.min_words(allc.filter(turn == 0), "body", MIN_WORDS).select(F.col("link_id").alias("id"))
    return L.comments_of_posts(posts, allc.filter(turn > 0), COMMENT_CAP + 1).select("id", "link_id", "author")


@register(
    "value_counts",
    f"""WITH {POSTS_SQL}
SELECT coalesce(language, 'unknown') AS language, count(*) AS n, round(count(*) / (SELECT count(*) FROM posts), 6) AS share
FROM posts GROUP BY 1""",
)
def q_value_counts(spark, sf):
    return C.value_counts(_posts(spark, sf), "language")


_PROBS = ", ".join(str(p) for p in C.DESCRIBE_PROBS)


@register(
    "describe",
    f"""WITH {POSTS_SQL}, w AS (SELECT CAST({WC} AS DOUBLE) AS x FROM posts), a AS (
  SELECT count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, [{_PROBS}]) AS q, max(x) AS max FROM w)
SELECT count, round(mean, 6) AS mean, round(std, 6) AS std, min,
       {', '.join(f'round(q[{i + 1}], 6) AS p{int(round(p * 100)):02d}' for i, p in enumerate(C.DESCRIBE_PROBS))}, max FROM a""",
)
def q_describe(spark, sf):
    return C.describe(C.with_word_count(_posts(spark, sf), "selftext"), "n_words")


_FENCES = f"""w AS (SELECT id, subreddit, selftext, {WC} AS n_words FROM posts),
f AS (SELECT quantile_cont(CAST(n_words AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(n_words AS DOUBLE), 0.75) AS q3 FROM w),
g AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM f)"""


@register(
    "iqr_filter",
    f"WITH {POSTS_SQL}, {_FENCES} SELECT id, n_words FROM w, g WHERE n_words IS NOT NULL AND n_words >= lo AND n_words <= hi",
)
def q_iqr_filter(spark, sf):
    # the counts are written once: the fences and the filter read them, not the texts
    counts = materialize(C.with_word_count(_posts(spark, sf), "selftext").select("id", "n_words"), "word-counts")
    return C.iqr_filter(counts, "n_words")


@register(
    "iqr_outliers",
    f"WITH {POSTS_SQL}, {_FENCES} SELECT id, subreddit, n_words, {preview_sql('selftext', 300)} AS preview FROM w, g WHERE n_words < lo OR n_words > hi",
)
def q_iqr_outliers(spark, sf):
    o = C.iqr_outliers(C.with_word_count(_posts(spark, sf), "selftext"), "n_words", "selftext")
    return o.select("id", "subreddit", "n_words", "preview")


_DOC_COLS = ("doc_id", "text", "lang", "source", "n_chars")


@register(
    "missing_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_missing FROM documents" for c in _DOC_COLS
    ),
)
def q_missing_profile(spark, sf):
    return C.missing_profile(tables.table(spark, sf, "documents"), _DOC_COLS)


def template_sql(col):
    s = f"lower({col})"
    s = f"regexp_replace({s}, '(https?://\\S+|www\\.\\S+)', ' URL ', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    s = f"regexp_replace({s}, '\\p{{Nd}}+', ' NUM ', 'g')"
    for ch in ("!", "\\?", "\\.", ","):
        s = f"regexp_replace({s}, '{ch}+', '{ch.replace(chr(92), '')}', 'g')"
    return s


@register("normalize_template", f"WITH {POSTS_SQL} SELECT id, {template_sql('selftext')} AS text_norm FROM posts")
def q_normalize_template(spark, sf):
    return _posts(spark, sf).select("id", H.normalize_template("selftext", True).alias("text_norm"))


@register(
    "epoch_to_ts",
    f"""WITH {POSTS_SQL}
SELECT id, strftime(to_timestamp(created_utc), '%Y-%m-%dT%H:%M:%SZ') AS created_utc_datetime FROM posts""",
)
def q_epoch_to_ts(spark, sf):
    ts = H.epoch_to_ts("created_utc")
    return _posts(spark, sf).select("id", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_utc_datetime"))


@register(
    "seq_ids",
    f"""WITH {POSTS_SQL}, kept AS (SELECT id FROM posts WHERE {NOT_BLANK} AND {WC} >= {MIN_WORDS})
SELECT id, 'hrp' || lpad(CAST(row_number() OVER (ORDER BY id) - 1 AS VARCHAR), 6, '0') AS post_id FROM kept""",
)
def q_seq_ids(spark, sf):
    kept = C.min_words(C.drop_blank(_posts(spark, sf), "selftext"), "selftext", MIN_WORDS).select("id")
    return I.formatted_ids(kept, ["id"], "post_id", "hrp", 6, start=0)


@register(
    "run_partition",
    f"""WITH {LISTING_SQL}, s AS (SELECT list_sort(list_distinct(list(subreddit))) AS subs, max(created_utc) AS t FROM listing)
SELECT regexp_replace(regexp_replace('top_{LISTING_N}_' ||
         (CASE WHEN length(regexp_replace(regexp_replace(array_to_string(subs, '+'), '[^\\p{{L}}\\p{{N}}\\-_.]', '_', 'g'), '^_+|_+$', '', 'g')) > 64
               THEN substr(regexp_replace(regexp_replace(array_to_string(subs, '+'), '[^\\p{{L}}\\p{{N}}\\-_.]', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60) || '_etc'
               ELSE regexp_replace(regexp_replace(array_to_string(subs, '+'), '[^\\p{{L}}\\p{{N}}\\-_.]', '_', 'g'), '^_+|_+$', '', 'g') END)
         || '_' || strftime(to_timestamp(t), '%Y%m%d_%H%M%S'), '[^\\p{{L}}\\p{{N}}\\-_.]', '_', 'g'), '^_+|_+$', '', 'g') AS run_name
FROM s""",
)
def q_run_partition(spark, sf):
    lst = tables.listing(spark, sf)
    s = lst.agg(
        F.array_join(F.array_sort(F.collect_set("subreddit")), "+").alias("subs"),
        F.max("created_utc").alias("t"),
    )
    stamp = F.date_format(F.timestamp_seconds("t"), "yyyyMMdd_HHmmss")
    return s.select(L.run_name(F.lit("top"), F.lit(LISTING_N), F.col("subs"), stamp).alias("run_name"))


@register(
    "clean_posts",
    f"""WITH {POSTS_SQL}, b AS (SELECT * FROM posts WHERE {NOT_BLANK}),
d AS (SELECT * FROM b WHERE id IN (SELECT min(id) FROM b GROUP BY selftext)),
m AS (SELECT * FROM d WHERE {WC} >= {MIN_WORDS}),
k AS (SELECT * FROM m WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
l AS (SELECT * FROM k WHERE coalesce(language, 'unknown') = '{TARGET_LANG}' OR id IN (SELECT doc_id FROM labels WHERE quality = 1))
SELECT id, subreddit, language, strftime(to_timestamp(created_utc), '%Y-%m-%dT%H:%M:%SZ') AS created_utc_datetime,
       {WC} AS selftext_word_count, 'id,subreddit,selftext,selftext_word_count,language,created_utc,created_utc_datetime' AS column_order FROM l""",
)
def q_clean_posts(spark, sf):
    """The cleaning chain: blank -> exact dedup -> min words -> id drop -> language (B16 placement)."""
    lbl = tables.table(spark, sf, "labels")
    p = C.drop_blank(_posts(spark, sf), "selftext")
    p = C.exact_dedup(p, "selftext", ("id",))
    p = C.min_words(p, "selftext", MIN_WORDS)
    p = C.drop_ids(p, lbl.filter("toxic = 1").select(F.col("doc_id").alias("id")))
    p = C.keep_language(p, TARGET_LANG, lbl.filter("quality = 1").select(F.col("doc_id").alias("id")))
    p = C.insert_after(p, "created_utc", "created_utc_datetime", F.date_format(H.epoch_to_ts("created_utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    p = C.insert_after(p, "selftext", "selftext_word_count", H.word_count("selftext"))
    return p.select("id", "subreddit", "language", "created_utc_datetime", "selftext_word_count", F.lit(",".join(p.columns)).alias("column_order"))


@register(
    "stage_report",
    f"""WITH {POSTS_SQL}, b AS (SELECT * FROM posts WHERE {NOT_BLANK}),
d AS (SELECT * FROM b WHERE id IN (SELECT min(id) FROM b GROUP BY selftext)),
m AS (SELECT * FROM d WHERE {WC} >= {MIN_WORDS}),
s AS (SELECT 0 AS step, 'read' AS stage, count(*) AS rows FROM posts UNION ALL SELECT 1, 'drop_blank', count(*) FROM b
      UNION ALL SELECT 2, 'exact_dedup', count(*) FROM d UNION ALL SELECT 3, 'min_words', count(*) FROM m)
SELECT step, stage, rows, lag(rows) OVER (ORDER BY step) - rows AS removed FROM s""",
)
def q_stage_report(spark, sf):
    r = C.cleaning_report(_posts(spark, sf), "selftext", MIN_WORDS)
    return r.select(F.col("step").cast("int").alias("step"), "stage", "rows", "removed")
