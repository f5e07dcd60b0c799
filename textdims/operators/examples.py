"""Ranked example texts per dimension pole, their annotation, and interpretation bundles
(E5, E9, J8, J9, H10-H14, C9, C12, C13).

Selection is a per-(factor, pole, group) top-k: ``row_number() <= k`` with a
literal bound is planned as a window group limit (each task keeps its top k
before the shuffle), so a group holding a third of all texts never moves
more than k rows per task.  Only the selected texts (a bounded number) are
tokenised and re-assembled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as H
from .tokens import tag_tokens

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
N_TOP = 20  # examples from the group ranked first on the pole
N_OTHER = 10  # examples from each other group
HIGHLIGHT_STOPLIST = ("edith", "doorbell", "michael", "recorded", "attempt", "request")
BOLD_OPEN, BOLD_CLOSE = "\\textbf{", "}"
BUNDLE_EXAMPLES = 10
BUNDLE_LINES = 30
# Header of a plain example.
TEXT_ID, GROUP, MODEL, FILE = "Text ID: ", "Group: ", "Model: ", "File:   "
# Headings of a bundle.
EXCERPT_BLOCK = "\n===== EXCERPT: %s (text ID %s) =====\n%s\n\n--- Loading words for this example (%s): %s\n"
MEANS_HEADING = "\n=== MEAN SOURCE SCORES ===\n"
LOADINGS_HEADING = "\n=== FACTOR LOADINGS ("
HEADING_END = ") ===\n"
EXCERPTS_HEADING = "\n=== EXAMPLE EXCERPTS ===\n"


def group_means(scores: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean score per (factor, group); ``scores`` long (text_id, factor, score), ``groups`` (text_id, group)."""
    return scores.join(groups, "text_id").groupBy("factor", "group").agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))


def top_examples(scores: DataFrame, groups: DataFrame, n_top: int = N_TOP, n_other: int = N_OTHER) -> DataFrame:
    """E5: per factor x pole, groups ranked by mean (desc for pos, asc for neg); the first
    group gives ``n_top`` non-zero texts, every other group ``n_other``, best scores first;
    ``ex_id`` numbers the examples in that order."""
    means = group_means(scores, groups)
    poles = F.explode(F.array(F.lit(1), F.lit(-1))).alias("pole")
    gm = means.select("factor", "group", "mean", poles)
    grank = F.row_number().over(Window.partitionBy("factor", "pole").orderBy((F.col("mean") * -F.col("pole")).asc(), F.col("group")))
    gm = gm.withColumn("group_rank", grank)
    s = scores.filter(F.col("score") != 0).join(groups, "text_id").select("text_id", "factor", "group", "score", poles)
    w = Window.partitionBy("factor", "pole", "group").orderBy((F.col("score") * -F.col("pole")).asc(), F.col("text_id"))
    ranked = s.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= max(n_top, n_other))
    j = ranked.join(gm.select("factor", "pole", "group", "group_rank", "mean"), ["factor", "pole", "group"])
    j = j.filter(F.col("rn") <= F.when(F.col("group_rank") == 1, F.lit(n_top)).otherwise(F.lit(n_other)))
    ex = F.row_number().over(Window.partitionBy("factor", "pole").orderBy("group_rank", "rn"))
    return j.withColumn("ex_id", ex).select("factor", "pole", "ex_id", "group", "group_rank", "rn", "text_id", "score", "mean")


def example_label(factor, pole, ex_id):
    return F.format_string("f%d_%s_%03d", factor, F.when(pole == 1, F.lit("pos")).otherwise(F.lit("neg")), ex_id)


def annotate_examples(examples: DataFrame, texts: DataFrame, pole_lemmas: DataFrame, stoplist=HIGHLIGHT_STOPLIST, text_col: str = "text") -> DataFrame:
    """J8 + H10-H14: tokens of each selected text re-assembled with pole lemmas marked.

    ``pole_lemmas``: (factor, pole, lemma) lemmas listed for each pole, secondary
    ones included; they are matched with the lemma as tagged.  Output per
    example: marked sentences joined by newlines (``paragraphs``) and the
    sorted matched lemma set.
    """
    sel = examples.select("factor", "pole", "ex_id", "text_id")
    t = texts.join(sel.select("text_id").distinct(), "text_id", "left_semi")
    cleaned = F.regexp_replace(F.col(text_col), r"[{}\\]", "")
    toks = tag_tokens(t.select("text_id", cleaned.alias("text")))
    per = sel.join(toks, "text_id")
    pl = pole_lemmas.filter(~F.col("lemma").isin(*stoplist)).select("factor", "pole", "lemma").distinct().withColumn("hit", F.lit(True))
    per = per.join(pl, ["factor", "pole", "lemma"], "left")
    marked = F.when(F.col("hit"), F.concat(F.lit(BOLD_OPEN), F.col("word"), F.lit(BOLD_CLOSE))).otherwise(F.col("word"))
    g = per.groupBy("factor", "pole", "ex_id", "text_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", marked.alias("w")))).alias("ws"),
        F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("lemma")))).alias("matched"),
    )
    text = H.detokenize(F.transform("ws", lambda s: s["w"]))
    text = H.escape_map(text, stripped=[])
    paras = F.transform(H.split_sentences(text), lambda p: H.wrap_symbols(p))
    return g.select("factor", "pole", "ex_id", "text_id", F.array_join(paras, "\n").alias("paragraphs"), F.array_join("matched", ", ").alias("matched_lemmas"))


def plain_examples(examples: DataFrame, texts: DataFrame, used: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """J8, second rendering + C13: (documents, uncovered (text_id, factor, pole)).

    A document is a header (text, group, model, file, score, loading words) and the full text.
    ``texts``: (text_id, group, model, file, text); ``used``: D19 rows.
    An example without a D19 row has no loading words and is reported as uncovered.
    """
    j = examples.select("factor", "pole", "ex_id", "text_id", "score").join(texts, "text_id").join(
        used.select("text_id", "factor", "pole", "n", "words"), ["text_id", "factor", "pole"], "left"
    )
    label = F.concat(F.lit("f"), F.col("factor").cast("string"), F.lit("_"), F.when(F.col("pole") == 1, F.lit("pos")).otherwise(F.lit("neg")))
    document = F.array_join(
        F.array(
            F.concat(F.lit(TEXT_ID), F.col("text_id").cast("string")),
            F.concat(F.lit(GROUP), F.col("group")),
            F.concat(F.lit(MODEL), F.col("model")),
            F.concat(F.lit(FILE), F.col("file")),
            F.lit(""),
            F.concat(F.lit("Score ("), label, F.lit("): "), F.col("score").cast("string")),
            F.concat(F.lit("Loading words ("), label, F.lit("), N="), F.coalesce("n", F.lit(0)).cast("string"), F.lit(": "), F.coalesce("words", F.lit(""))),
            F.lit(""),
        ),
        "\n",
    )
    docs = j.select("factor", "pole", "ex_id", "text_id", F.concat(document, F.col(text_col)).alias("document"))
    return docs, j.filter(F.col("n").isNull()).select("text_id", "factor", "pole").distinct()


def head_lines(c, n: int = BUNDLE_LINES):
    """First n lines of a text."""
    return F.array_join(F.slice(F.split(c, "\n"), 1, n), "\n")


def interpretation_bundle(examples: DataFrame, excerpts: DataFrame, loadings_text: DataFrame, means_text: DataFrame,
                          system_text: str, task_template: str, n_examples: int = BUNDLE_EXAMPLES, n_lines: int = BUNDLE_LINES) -> DataFrame:
    """One prompt per (factor, pole): system, task, group means, loadings, first
    ``n_examples`` excerpts (``n_lines`` lines each) with text id and loading words.

    ``excerpts``: (factor, pole, ex_id, text_id, body, loading_words); the
    per-pole list is bounded by ``n_examples``.
    """
    ex = excerpts.filter(F.col("ex_id") <= n_examples)
    block = F.format_string(
        EXCERPT_BLOCK,
        example_label(F.col("factor"), F.col("pole"), F.col("ex_id")),
        F.col("text_id").cast("string"),
        head_lines(F.col("body"), n_lines),
        F.when(F.col("pole") == 1, F.lit("pos")).otherwise(F.lit("neg")),
        F.when(F.col("loading_words") == "", F.lit("(none)")).otherwise(F.col("loading_words")),
    )
    blocks = ex.groupBy("factor", "pole").agg(F.array_sort(F.collect_list(F.struct("ex_id", block.alias("b")))).alias("bs"))
    j = blocks.join(loadings_text, ["factor", "pole"], "left").join(means_text, "factor", "left")
    pole_name = F.when(F.col("pole") == 1, F.lit("pos")).otherwise(F.lit("neg"))
    task = F.format_string(task_template, F.concat(F.lit("f"), F.col("factor").cast("string")), pole_name)
    prompt = F.concat(
        F.lit(system_text), F.lit("\n\n"), task, F.lit("\n"),
        F.lit(MEANS_HEADING), F.coalesce(F.col("means"), F.lit("")), F.lit("\n"),
        F.lit(LOADINGS_HEADING), F.concat(F.lit("f"), F.col("factor").cast("string"), F.lit("_"), pole_name), F.lit(HEADING_END),
        F.coalesce(F.col("loadings"), F.lit("")), F.lit("\n"),
        F.lit(EXCERPTS_HEADING), F.array_join(F.transform("bs", lambda s: s["b"]), "\n"),
    )
    return j.select("factor", "pole", prompt.alias("prompt"))


def with_available_text(scores: DataFrame, texts: DataFrame, key: str = "text_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose text exists, keys of the missing ones) - left semi and left anti joins."""
    avail = scores.join(texts.select(key), key, "left_semi")
    missing = scores.select(key).distinct().join(texts.select(key), key, "left_anti")
    return avail, missing


def attach_group_means(scores: DataFrame, means: DataFrame, on=("factor", "group")) -> DataFrame:
    """Equi join of each text's score with its group mean (the means table has one row per level)."""
    return scores.join(means, list(on), "left")


def parse_pole_list(c):
    """Items of an ``a (.45), (b (.31))`` list; parenthesised items are secondary.

    Returns array<struct<item string, loading double, primary boolean>>.
    """
    items = F.regexp_extract_all(c, F.lit(r"(\(?[^\s,()]+ \(-?[0-9]*\.[0-9]+\)\)?)"), 1)
    return F.transform(items, lambda x: F.struct(
        F.regexp_extract(x, r"^\(?([^\s,()]+)", 1).alias("item"),
        F.regexp_extract(x, r"\((-?[0-9]*\.[0-9]+)\)", 1).cast("double").alias("loading"),
        (~x.startswith("(")).alias("primary"),
    ))
