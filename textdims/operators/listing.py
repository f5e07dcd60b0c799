"""Listing-side operators: row normalisation, listing limits, comment caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as H

# Fixed values
PERMALINK_PREFIX = "https://reddit.com"
LINK_PREFIX = "t3_"


def normalize_submission(raw: DataFrame, *more: Column) -> DataFrame:
    """A3: raw record -> submission row (epoch int default 0, author null when absent,
    absolute permalink, over_18 default false), with the columns ``more`` beside it."""
    cols = set(raw.columns)

    def opt(name, default=None, cast=None):
        c = F.col(name) if name in cols else F.lit(default)
        return c.cast(cast) if cast else c

    return raw.select(
        F.col("id").cast("string").alias("id"),
        opt("subreddit", cast="string").alias("subreddit"),
        F.coalesce(opt("created_utc").try_cast("double").cast("long"), F.lit(0)).alias("created_utc"),
        opt("author", cast="string").alias("author"),
        opt("title", cast="string").alias("title"),
        opt("selftext", cast="string").alias("selftext"),
        opt("score", cast="long").alias("score"),
        opt("num_comments", cast="long").alias("num_comments"),
        opt("url", cast="string").alias("url"),
        F.concat(F.lit(PERMALINK_PREFIX), opt("permalink", "", "string")).alias("permalink"),
        F.coalesce(opt("over_18", cast="boolean"), F.lit(False)).alias("over_18"),
        opt("removed_by_category", cast="string").alias("removed_by_category"),
        *more,
    )


def normalize_comment(raw: DataFrame, *more: Column) -> DataFrame:
    """A4: raw record -> comment row, with the columns ``more`` beside it; every ``t3_`` removed from link_id; parent_id unchanged."""
    cols = set(raw.columns)

    def opt(name, default=None, cast=None):
        c = F.col(name) if name in cols else F.lit(default)
        return c.cast(cast) if cast else c

    link = opt("link_id", cast="string")
    return raw.select(
        F.col("id").cast("string").alias("id"),
        F.when((link.isNull()) | (link == ""), F.lit(None).cast("string")).otherwise(F.replace(link, F.lit(LINK_PREFIX), F.lit(""))).alias("link_id"),
        opt("parent_id", cast="string").alias("parent_id"),
        opt("subreddit", cast="string").alias("subreddit"),
        F.coalesce(opt("created_utc").try_cast("double").cast("long"), F.lit(0)).alias("created_utc"),
        opt("author", cast="string").alias("author"),
        opt("body", cast="string").alias("body"),
        opt("score", cast="long").alias("score"),
        F.concat(F.lit(PERMALINK_PREFIX), opt("permalink", "", "string")).alias("permalink"),
        opt("removed_by_category", cast="string").alias("removed_by_category"),
        *more,
    )


def listing_limit(df: DataFrame, n: int | None, listing: str = "new", group_col: str = "subreddit") -> DataFrame:
    """Per group the n newest ('new') or n top-scored ('top') items; all when n is None.

    ``row_number() <= n`` runs as a per-task group limit before the shuffle,
    so a hot group ships at most n rows per map task.
    """
    if n is None:
        return df
    if listing == "new":
        order = [F.col("created_utc").desc(), F.col("id").asc()]
    elif listing == "top":
        order = [F.col("score").desc(), F.col("id").asc()]
    else:
        raise ValueError(f"unsupported listing {listing!r}")
    w = Window.partitionBy(group_col).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def cap_comments(comments: DataFrame, n: int | None, key: str = "link_id", order=("created_utc", "id")) -> DataFrame:
    """First n comments per post; none when n == 0, all when n is None."""
    if n is None:
        return comments
    if n <= 0:
        return comments.limit(0)
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order])
    return comments.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def comments_of_posts(posts: DataFrame, comments: DataFrame, n: int | None = None, post_key: str = "id", link_key: str = "link_id") -> DataFrame:
    """C11: comments of the given posts (one-to-many equi join), capped per post."""
    p = posts.select(F.col(post_key).alias(link_key))
    return cap_comments(comments.join(p, link_key, "left_semi"), n, key=link_key)


def run_name(listing, limit, subreddits_joined, stamp) -> "F.Column":
    """``<listing>_<limit|nolimit>_<subreddits>_<stamp>`` made path-safe."""
    lim = F.when(limit.isNull(), F.lit("nolimit")).otherwise(limit.cast("long").cast("string"))
    return H.slug(F.concat_ws("_", listing, lim, H.slug_capped(subreddits_joined, 64), stamp))
