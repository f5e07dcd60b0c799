"""Cleaning filters, duplicate handling and column profiles.

Every function is ``DataFrame -> DataFrame``.  Reports are small aggregate
DataFrames (never Python loops over collected rows).  Hot groups (one text
copied a third of all rows, one huge family) are handled by aggregates with
map-side combine (``min_by``, ``count``) instead of windows over the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as H
from ..session import materialize


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """B1: drop null and whitespace-only text."""
    return df.filter(~H.is_blank(col))


def with_word_count(df: DataFrame, col: str, out: str = "n_words") -> DataFrame:
    return df.withColumn(out, H.word_count(col))


def min_words(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """B2: keep rows with >= n words."""
    return df.filter(H.word_count(col) >= n)


def min_words_report(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """B2 report: total rows, rows below n words and their share."""
    below = (H.word_count(col) < n).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_total"), F.sum(below).alias("n_below")).select(
        "n_total",
        F.coalesce("n_below", F.lit(0)).alias("n_below"),
        F.round(F.when(F.col("n_total") > 0, F.col("n_below") / F.col("n_total")).otherwise(0.0), 6).alias("share_below"),
    )


def _word_terms(terms) -> bool:
    import re

    return all(re.fullmatch(r"\w+", t) for t in terms)


def matched_terms(col, terms) -> Column:
    """Sorted distinct lower-cased whole-word hits of any term (case-insensitive)."""
    lowered = [t.lower() for t in terms]
    if _word_terms(terms):
        ws = F.transform(H.words(col), lambda w: F.lower(w))
        hits = F.filter(ws, lambda w: w.isin(*lowered))
    else:
        import re

        alt = "|".join(re.escape(t) for t in terms)
        hits = F.transform(F.regexp_extract_all(F.col(col) if isinstance(col, str) else col, F.lit(rf"(?iU)\b(?:{alt})\b"), 0), F.lower)
    return F.array_sort(F.array_distinct(hits))


def match_terms(df: DataFrame, col: str, terms, preview_chars: int = 300) -> DataFrame:
    """B3 + B17: rows matching any term, with the matched terms and a preview."""
    m = matched_terms(col, terms)
    return (
        df.withColumn("matched_terms", m)
        .filter(F.size("matched_terms") > 0)
        .withColumn("preview", H.preview(col, preview_chars))
    )


def match_share(df: DataFrame, col: str, terms) -> DataFrame:
    hit = (F.size(matched_terms(col, terms)) > 0).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_total"), F.sum(hit).alias("n_match")).select(
        "n_total", F.coalesce("n_match", F.lit(0)).alias("n_match"),
        F.round(F.when(F.col("n_total") > 0, F.col("n_match") / F.col("n_total")).otherwise(0.0), 6).alias("share"),
    )


def drop_ids(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Remove listed ids (anti join; AQE broadcasts the list only when measured small)."""
    return df.join(ids.select(F.col(id_col)).distinct(), id_col, "left_anti")


def drop_ids_report(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """B4 report: requested / found / missing counts (F7 = requested - found)."""
    req = ids.select(id_col).distinct()
    found = req.join(df.select(id_col), id_col, "left_semi").select(F.count(F.lit(1))).scalar()
    missing = req.join(df.select(id_col), id_col, "left_anti").select(F.count(F.lit(1))).scalar()
    return req.agg(F.count(F.lit(1)).alias("requested")).select("requested", found.alias("found"), missing.alias("missing"))


def keep_language(df: DataFrame, lang: str, allow_ids: DataFrame | None = None, lang_col: str = "language", id_col: str = "id") -> DataFrame:
    """Keep rows in ``lang`` (null counts as 'unknown') or whose id is allow-listed."""
    in_lang = F.coalesce(F.col(lang_col), F.lit("unknown")) == lang
    if allow_ids is None:
        return df.filter(in_lang)
    allow = allow_ids.select(F.col(id_col).alias("_allow_id")).distinct().withColumn("_allowed", F.lit(True))
    j = df.join(allow, df[id_col] == allow["_allow_id"], "left")
    return j.filter(in_lang | F.col("_allowed").isNotNull()).drop("_allow_id", "_allowed")


def non_target_language(df: DataFrame, lang: str, col: str, lang_col: str = "language", preview_chars: int = 400) -> DataFrame:
    """Rows not in the target language, with a preview, sorted language, subreddit, id."""
    lc = F.coalesce(F.col(lang_col), F.lit("unknown"))
    return (
        df.filter(lc != lang)
        .withColumn(lang_col, lc)
        .withColumn("preview", H.preview(col, preview_chars))
        .orderBy(lang_col, "subreddit", "id")
    )


def lookup_id(df: DataFrame, value, id_col: str = "id") -> DataFrame:
    """Point lookup (pushed into the parquet scan)."""
    return df.filter(F.col(id_col) == value)


def drop_groups(df: DataFrame, col: str, values) -> DataFrame:
    """Drop rows whose group is listed."""
    return df.filter(~F.col(col).isin(list(values)) | F.col(col).isNull())


def time_window(df: DataFrame, after=None, before=None, col: str = "created_utc") -> DataFrame:
    """Keep after <= col <= before, each bound optional."""
    cond = F.lit(True)
    if after is not None:
        cond = cond & (F.col(col) >= after)
    if before is not None:
        cond = cond & (F.col(col) <= before)
    return df.filter(cond)


def quantiles(df: DataFrame, col: str, probs) -> Column:
    """Exact linearly interpolated percentiles of a column as one array value, by ranks over range partitions: no buffer holds the column's values."""
    from .groups import exact_quantiles

    return exact_quantiles(df.select(F.lit(0).alias("_g"), F.col(col).alias("_v")), "_g", "_v", probs).select("q").scalar()


def iqr_fences(df: DataFrame, col: str) -> DataFrame:
    """One row: q1, q3, iqr, lower, upper over non-null values of ``col``."""
    q = df.sparkSession.range(1).select(quantiles(df, col, [0.25, 0.75]).alias("q"))
    return q.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")).select(
        "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper"),
    )


def _fence_values(df: DataFrame, col: str):
    f = iqr_fences(df, col).select(F.struct("lower", "upper")).scalar()
    return f["lower"], f["upper"]


def iqr_filter(df: DataFrame, col: str) -> DataFrame:
    """Keep non-null rows inside [Q1-1.5 IQR, Q3+1.5 IQR] (fences from the whole column, once)."""
    lo, hi = _fence_values(df, col)
    return df.filter(F.col(col).isNotNull() & (F.col(col) >= lo) & (F.col(col) <= hi))


def iqr_outliers(df: DataFrame, col: str, text_col: str | None = None, preview_chars: int = 300) -> DataFrame:
    """Rows outside the fences, sorted by value desc, with a preview.

    The rows are written once: the fences, the bounds of the sort and the result itself read
    the value, which may be a count over a text, and do not work it out again.
    """
    from ..session import materialize

    df = materialize(df, "measured")
    lo, hi = _fence_values(df, col)
    out = df.filter((F.col(col) < lo) | (F.col(col) > hi))
    if text_col:
        out = out.withColumn("preview", H.preview(text_col, preview_chars))
    return out.orderBy(F.col(col).desc(), F.col("id"))


def insert_after(df: DataFrame, after: str, name: str, expr: Column) -> DataFrame:
    """Add a column right of ``after``."""
    cols = [c for c in df.columns if c != name]
    i = cols.index(after) + 1
    sel = [F.col(c) for c in cols[:i]] + [expr.alias(name)] + [F.col(c) for c in cols[i:]]
    return df.select(*sel)


def text_key(col: str) -> Column:
    """SHA-256 of a text as 32 bytes: what duplicates are grouped and joined on, so that no text is shuffled as a key."""
    return F.unhex(F.sha2(F.col(col).cast("binary"), 256))


def duplicate_report(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text occurs more than once, with the count.

    Counts come from an aggregate (map-side combine, so one text copied a
    third of all rows costs one row per map task); the join back is planned
    by AQE (broadcast when the duplicated set is small, skew-split otherwise).
    """
    keyed = df.withColumn("_k", text_key(col))
    counts = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias("text_count")).filter(F.col("text_count") > 1)
    return keyed.join(counts, "_k", "inner").drop("_k")


def exact_dedup(df: DataFrame, col: str, order_cols=("id",)) -> DataFrame:
    """Keep the first row per text in (order_cols) order; ``order_cols`` identify a row.

    The least order key of each text key is a partial aggregate (no window over a
    hot text); the rows that hold one stay, by a semi-join on it.
    """
    # one column is a hash aggregate, several are a struct
    order = F.col(order_cols[0]) if len(order_cols) == 1 else F.struct(*[F.col(c) for c in order_cols])
    keyed = df.withColumn("_k", text_key(col)).withColumn("_o", order)
    first = keyed.groupBy("_k").agg(F.min("_o").alias("_f"))
    same = keyed["_k"].eqNullSafe(first["_k"]) & keyed["_o"].eqNullSafe(first["_f"])
    return keyed.join(first, same, "left_semi").drop("_k", "_o")


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """D3: rows and distinct values of a column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(text_key(col)).alias("n_distinct"))


def value_counts(df: DataFrame, col: str, missing: str = "unknown") -> DataFrame:
    """N and share per value (null -> ``missing``), desc."""
    total = df.select(F.count(F.lit(1))).scalar()
    v = F.coalesce(F.col(col), F.lit(missing))
    return (
        df.groupBy(v.alias(col))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", F.round(F.col("n") / total, 6))
        .orderBy(F.col("n").desc(), F.col(col))
    )


DESCRIBE_PROBS = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def describe(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Count, mean, std (n-1), min, percentiles, max of a numeric column."""
    c = F.col(col).cast("double")
    base = df.filter(F.col(col).isNotNull())
    agg = base.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ).withColumn("_p", quantiles(base, col, DESCRIBE_PROBS))
    sel = [F.col("count"), F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"), F.col("min")]
    for i, p in enumerate(DESCRIBE_PROBS):
        sel.append(F.round(F.col("_p")[i], digits).alias(f"p{int(round(p * 100)):02d}"))
    sel.append(F.col("max"))
    return agg.select(*sel)


def missing_profile(df: DataFrame, cols=None) -> DataFrame:
    """Per column: n (non-missing) and n_missing; one aggregate pass, then unpivot."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"n__{c}"))
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"m__{c}"))
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n__{c}").alias("n"), F.coalesce(F.col(f"m__{c}"), F.lit(0)).alias("n_missing")) for c in cols])
    return wide.select(F.explode(pairs).alias("s")).select("s.*")


def keep_earliest(df: DataFrame, group_col: str, ts_col: str = "created_utc", id_col: str = "id") -> DataFrame:
    """E4 + F2: one row per non-null group (smallest ts, then id); rows without a group kept."""
    cols = df.columns
    clustered = df.filter(F.col(group_col).isNotNull())
    reps = (
        clustered.groupBy(group_col)
        .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts_col), F.col(id_col))).alias("_r"))
        .select("_r.*")
    )
    return df.filter(F.col(group_col).isNull()).unionByName(reps)


def cleaning_report(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """D21 of the cleaning head (blank, exact duplicates, short texts) in one pass: equal texts pass
    or fail every step together, so counts by text key hold all the steps."""
    per_text = df.select(text_key(col).alias("k"), (~H.is_blank(col)).alias("filled"), (H.word_count(col) >= n).alias("long")).groupBy("k", "filled", "long").agg(F.count(F.lit(1)).alias("n"))
    t = per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.when(F.col("filled"), F.col("n"))), F.lit(0)).alias("drop_blank"),
        F.count(F.when(F.col("filled"), 1)).alias("exact_dedup"),
        F.count(F.when(F.col("filled") & F.col("long"), 1)).alias("min_words"),
    )
    steps = ("read", "drop_blank", "exact_dedup", "min_words")
    rows = [F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("rows"), ((F.col(steps[i - 1]) - F.col(s)) if i else F.lit(None).cast("long")).alias("removed")) for i, s in enumerate(steps)]
    return t.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def pipeline_report(df: DataFrame, stages, write_before=()) -> tuple[DataFrame, DataFrame]:
    """D21 of any chain of stages: (its result, written once; a table of step, stage, rows, removed).

    ``stages`` lists (name, function of a DataFrame).  The rows behind each stage are counted by
    an observation on the one execution that writes the result, so the texts are read
    once.  The input of the stages in ``write_before``, those that run jobs of their own
    (near duplicates), is written first, so that no earlier stage is computed again.
    What is written is packed tightly, and the shuffle files of a write go with it.
    """
    from pyspark.sql import Observation

    from ..session import materialize

    counts = []

    def watch(rows: DataFrame, name: str) -> DataFrame:
        seen = Observation(f"stage {len(counts)}")
        counts.append((name, seen))
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"))

    rows = watch(df, "read")
    for name, stage in stages:
        if name in write_before:
            rows = materialize(rows, "stage-input", compression="zstd", tidy=True)
        rows = watch(stage(rows), name)
    result = materialize(rows, "stage-result", compression="zstd", tidy=True)
    numbers = [int(seen.get["rows"]) for _, seen in counts]
    steps = [(k, counts[k][0], n, numbers[k - 1] - n if k else None) for k, n in enumerate(numbers)]
    return result, df.sparkSession.createDataFrame(steps, "step int, stage string, rows long, removed long")


def gram_sizes(df: DataFrame, grams: Column, id_col: str = "id") -> DataFrame:
    """H3 by text: (id, n_grams, n_distinct) of every text with any gram.

    Grams are counted inside their row.  Rows that share an id, found by a count of
    the ids, count together: only their grams are written out one by one.
    """
    rows = df.select(F.col(id_col).alias("id"), grams.alias("grams")).select("id", F.size("grams").alias("n"), F.size(F.array_distinct("grams")).alias("d"))
    counted = materialize(rows.groupBy("id").agg(F.sum("n").alias("n_grams"), F.max("d").cast("long").alias("n_distinct"), F.count(F.lit(1)).alias("rows")), "gram-sizes")
    several = materialize(counted.filter("rows > 1").select(F.col("id").alias("again")), "gram-ids")
    again = df.join(several, F.col(id_col).eqNullSafe(F.col("again")), "left_semi").select(F.col(id_col).alias("id"), F.explode(grams).alias("gram"))
    again = again.groupBy("id").agg(F.count(F.lit(1)).alias("n_grams"), F.count_distinct("gram").alias("n_distinct"))
    return counted.filter("rows = 1 AND n_grams > 0").select("id", "n_grams", "n_distinct").unionByName(again)
