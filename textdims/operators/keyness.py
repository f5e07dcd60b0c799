"""Keyness of lemmas per stratum against the rest of the corpus.

Plan shape (documents -> keyness):

1. per-text distinct words, row-local (``tokens.text_words``) - no shuffle;
2. ``groupBy(word, stratum).count()`` - one shuffle, map-side partial counts; the
   content test (``tokens.content_lemmas``) comes after it, once for each counted word;
3. ``groupBy(lemma)`` collecting the (stratum -> a) map - a second, small shuffle
   of already-aggregated rows (at most #strata entries per lemma);
4. stratum sizes enter as a scalar subquery (one value, #strata entries), so
   no join and no unbounded broadcast is needed; all the rest is column math.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import keyness_status, log_likelihood, pct_diff
from .tokens import content_lemmas

STATUS_PRIORITY = {"POSKW": 0, "NEGKW": 1, "NOTKW": 2}
UNKNOWN_STRATUM = "unknown"


def _stratum(col: str = "stratum"):
    """A missing stratum is a stratum of its own."""
    return F.coalesce(F.col(col).cast("string"), F.lit(UNKNOWN_STRATUM))


def _counts(presence: DataFrame, out: str) -> DataFrame:
    """(lemma, stratum, ``out``) of lemmas, or of the words of ``tokens.text_words``: each word is tested once, after the counts."""
    n = F.count(F.lit(1)).alias(out)
    if "lemma" in presence.columns:
        return presence.groupBy("lemma", _stratum().alias("stratum")).agg(n)
    return content_lemmas(presence.groupBy("word", _stratum().alias("stratum")).agg(n), out)


def doc_frequency(presence: DataFrame) -> DataFrame:
    """Number of distinct texts per (stratum, lemma); ``presence`` is distinct already, with lemmas or with the words of ``tokens.text_words``."""
    return _counts(presence, "n_texts").select("stratum", "lemma", "n_texts")


def stratum_sizes(texts: DataFrame, stratum_col: str = "stratum") -> DataFrame:
    return texts.groupBy(_stratum(stratum_col).alias("stratum")).agg(F.count(F.lit(1)).alias("size"))


def _per_lemma(counts: DataFrame, count_col: str) -> DataFrame:
    return counts.groupBy("lemma").agg(
        F.map_from_entries(F.collect_list(F.struct("stratum", count_col))).alias("m"),
        F.sum(count_col).alias("g"),
    )


def _against_rest(per_lemma: DataFrame, sizes: DataFrame, only_present: bool) -> DataFrame:
    """(lemma, stratum, a, g, c, d): counts in the stratum and in all, sizes of the stratum and of the rest.

    The strata enter as one value (#strata entries).  With ``only_present`` a lemma's own
    strata are exploded, otherwise every stratum is.
    """
    total = sizes.select(F.sum("size")).scalar()
    if only_present:
        size_of = sizes.select(F.map_from_entries(F.collect_list(F.struct("stratum", "size")))).scalar()
        rows = per_lemma.select("lemma", "g", F.explode("m").alias("stratum", "a")).withColumn("c", F.element_at(size_of, F.col("stratum")))
    else:
        strata = sizes.select(F.collect_list(F.struct("stratum", "size"))).scalar()
        rows = per_lemma.select("lemma", "m", "g", F.explode(strata).alias("s")).select(
            "lemma", "g", F.col("s.stratum").alias("stratum"), F.coalesce(F.col("m")[F.col("s.stratum")], F.lit(0)).alias("a"), F.col("s.size").alias("c")
        )
    return rows.select("lemma", "stratum", F.col("a").cast("long").alias("a"), F.col("g").cast("long").alias("g"), "c", (total - F.col("c")).alias("d"))


def _keyness_columns(a, b, c, d, digits: int | None) -> list:
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    per_a = F.when(c > 0, a / c * 1000.0).otherwise(F.lit(0.0))
    per_b = F.when(d > 0, b / d * 1000.0).otherwise(F.lit(0.0))
    expected = F.when(c + d > 0, c * (a + b) / (c + d)).otherwise(F.lit(0.0))
    ll = log_likelihood(a, b, c, d)
    diff = pct_diff(per_a, per_b)
    status = keyness_status(ll, diff)

    def r(x):
        return F.round(x, digits) if digits is not None else x

    return [
        r(per_a).alias("target_per_1k"),
        r(per_b).alias("comparison_per_1k"),
        r(expected).alias("expected"),
        r(ll).alias("ll"),
        r(diff).alias("pct_diff"),
        status.alias("status"),
        F.round(ll, 2).alias("ll_rank_key"),
    ]


def keyness(presence: DataFrame, texts: DataFrame, cutoff_pct: float = 3.0, digits: int | None = 6) -> DataFrame:
    """Per stratum vs. the rest, lemmas present in >= cutoff % of the target texts.

    ``presence``: distinct (text_id, stratum, lemma), or the texts' words as
    ``tokens.text_words`` gives them; ``texts``: all texts with
    their stratum (sizes count texts without any content lemma too).
    Columns: stratum, lemma, target_count, comparison_count, target_per_1k,
    comparison_per_1k, expected, ll, pct_diff, status, ll_rank_key.
    """
    sizes = stratum_sizes(texts)
    counts = _counts(presence, "a")
    # a positive cut-off leaves no stratum in which a lemma doesn't occur
    rows = _against_rest(_per_lemma(counts, "a"), sizes, only_present=cutoff_pct > 0)
    rows = rows.filter((F.col("c") > 0) & (F.col("a") >= F.col("c") * float(cutoff_pct) / 100.0))
    b = F.col("g") - F.col("a")
    return rows.select(
        "stratum",
        "lemma",
        F.col("a").alias("target_count"),
        b.alias("comparison_count"),
        *_keyness_columns(F.col("a"), b, F.col("c"), F.col("d"), digits),
    )


def token_keyness(tokens: DataFrame, digits: int | None = 6) -> DataFrame:
    """Keyness on token counts, every global lemma for every label, no cut-off.

    ``tokens``: (stratum, lemma) one row per token occurrence.
    """
    counts = tokens.groupBy("lemma", _stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("a"))
    rows = _against_rest(_per_lemma(counts, "a"), counts.groupBy("stratum").agg(F.sum("a").alias("size")), only_present=False)
    b = F.col("g") - F.col("a")
    return rows.select(
        "stratum",
        "lemma",
        F.col("a").alias("target_count"),
        b.alias("comparison_count"),
        *_keyness_columns(F.col("a"), b, F.col("c"), F.col("d"), digits),
    )


def status_priority(col="status"):
    c = F.col(col)
    return F.when(c == "POSKW", 0).when(c == "NEGKW", 1).otherwise(2)


def rank_order():
    """E1 order inside a stratum: status priority, rounded LL desc, lemma."""
    return [status_priority().asc(), F.col("ll_rank_key").desc(), F.col("lemma").asc()]


def rank_keyness(kn: DataFrame) -> DataFrame:
    """Rank of every lemma inside its stratum (priority, rounded LL desc, lemma).

    Distributed numbering (range sort and offsets): no stratum has to fit one task.
    """
    from .ids import sequential_ids

    keyed = kn.withColumn("_prio", status_priority()).withColumn("_neg_ll", -F.col("ll_rank_key"))
    s = sequential_ids(keyed, ["stratum", "_prio", "_neg_ll", "lemma"], out="_seq")
    first = s.groupBy("stratum").agg(F.min("_seq").alias("_first"))
    return s.join(first, "stratum").withColumn("rank", F.col("_seq") - F.col("_first") + 1).drop("_prio", "_neg_ll", "_seq", "_first")


def keyword_shape(kn: DataFrame) -> DataFrame:
    """POSKW lemmas without punctuation, decimal digits or upper case."""
    return kn.filter(
        (F.col("status") == "POSKW")
        & ~F.col("lemma").rlike(r"[\p{P}\p{Nd}\p{Lu}\x{00B2}\x{00B3}\x{00B9}\x{2070}-\x{2079}\x{2080}-\x{2089}]")
    )


def quota_topk(kn: DataFrame, ceiling: int, weighted_stratum: str = "human", weight: int = 2) -> DataFrame:
    """First ``ceiling`` keywords per stratum (``ceiling*weight`` for the weighted one).

    ``row_number() <= k`` is planned as a WindowGroupLimit: every map task keeps
    only its top k per stratum before the shuffle, so a hot stratum never
    sends more than k rows per task.
    """
    quota = F.when(F.col("stratum") == weighted_stratum, F.lit(ceiling * weight)).otherwise(F.lit(ceiling))
    w = Window.partitionBy("stratum").orderBy(*rank_order())
    kmax = ceiling * max(1, weight)
    ranked = keyword_shape(kn).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= kmax)
    return ranked.filter(F.col("rank") <= quota)


def consolidate(selected: DataFrame, max_total: int, weighted_stratum: str = "human") -> DataFrame:
    """Strata in order weighted -> summary_guided_* -> others -> generic_*,
    cut at ``max_total`` before the distinct, then the sorted distinct list."""
    s = F.col("stratum")
    prio = (
        F.when(s == weighted_stratum, 0)
        .when(s.startswith("summary_guided_"), 1)
        .when(s.startswith("generic_"), 3)
        .otherwise(2)
    )
    head = selected.withColumn("_p", prio).orderBy("_p", "stratum", "rank").limit(max_total)
    return head.select("lemma").distinct()
