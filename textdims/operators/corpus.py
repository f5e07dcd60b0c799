"""Corpus size report (D9, B20): texts and words by source, model, source x model, season, overall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as H
from .tokens import TOKEN_PATTERN

# Fixed value: a line counts when it starts with a Latin letter.
COUNTED_LINE = r"^[A-Za-z]"


def faithful_words(c) -> "F.Column":
    """Whitespace tokens summed over lines that start with a Latin letter."""
    lines = F.filter(F.split(c, "\n"), lambda ln: ln.rlike(COUNTED_LINE))
    return F.aggregate(lines, F.lit(0).cast("long"), lambda acc, ln: acc + F.size(F.filter(F.split(ln, r"\s+"), lambda x: x != "")))


def tagged_words(c, count: str = "faithful") -> "F.Column":
    """Words of a text that would be tagged one token a line (word, tag, lemma).

    ``faithful`` counts as the method does: the white-space separated fields of
    every line that starts with a Latin letter, three of them; ``tokens`` counts such lines.
    """
    if count not in ("faithful", "tokens"):
        raise ValueError("count must be 'faithful' or 'tokens'")
    lines = F.size(F.filter(F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), 0), lambda w: w.rlike(COUNTED_LINE)))
    return (F.greatest(lines, F.lit(0)) * (3 if count == "faithful" else 1)).cast("long")


def corpus_size(texts: DataFrame, words_col: str = "n_words") -> DataFrame:
    """One aggregate with grouping sets (source), (model), (source, model), (season), ().

    Output: kind, key, n_texts, n_words.
    """
    g = texts.groupingSets(
        [["source"], ["model"], ["source", "model"], ["season"], []], "source", "model", "season"
    ).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n_texts"), F.sum(words_col).alias("n_words"))
    # grouping_id bits: source=4, model=2, season=1 (1 = aggregated away)
    kind = (
        F.when(F.col("gid") == 3, F.lit("source"))
        .when(F.col("gid") == 5, F.lit("model"))
        .when(F.col("gid") == 1, F.lit("source/model"))
        .when(F.col("gid") == 6, F.lit("season"))
        .otherwise(F.lit("overall"))
    )
    key = (
        F.when(F.col("gid") == 3, F.col("source"))
        .when(F.col("gid") == 5, F.col("model"))
        .when(F.col("gid") == 1, F.concat_ws("/", "source", "model"))
        .when(F.col("gid") == 6, F.col("season"))
        .otherwise(F.lit("overall"))
    )
    return g.select(kind.alias("kind"), key.alias("key"), "n_texts", F.col("n_words").cast("long").alias("n_words"))


def corpus_texts(texts: DataFrame, name_col: str = "name", folder_col: str = "folder", text_col: str = "text", words=None) -> DataFrame:
    """Per text: source (human/ai), model (= folder), season from the name, word count.

    ``text_col`` holds tagged lines, as they lie in the files; ``words`` takes another
    count, such as ``tagged_words`` of a text that is not tagged yet.
    """
    return texts.select(
        F.when(F.col(folder_col) == "human", F.lit("human")).otherwise(F.lit("ai")).alias("source"),
        F.col(folder_col).alias("model"),
        H.derive_season(F.col(name_col)).alias("season"),
        (faithful_words(F.col(text_col)) if words is None else words).alias("n_words"),
    )
