"""Small tables for the operators' tests."""

import pathlib
import random
import sys

from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).parents[2]))

#: Names that operators use inside; an input may have columns of the same names.
CLASHING = ("score", "n_tokens", "ids", "fp", "g", "rest", "digit", "key", "row", "n_words", "spans", "lines", "y", "id", "unit")


def docs(spark, rows):
    """(doc_id, text) rows as a table of documents with clashing extra columns."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x"))
    return df


def words(rng: random.Random, n: int, kinds: int = 200) -> str:
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


#: Rows that every operator has to take: nulls, empty and blank texts, repeats, one long text, odd characters.
ODD = [(None, "no id at all"), (None, None), (1, None), (2, ""), (3, "   \n\t "), (4, "plain words here"), (4, "plain words here"), (5, "Ünïcödé — 文字列 🙂 \x1c\x85   end"), (6, "long " * 60_000), (7, "\n".join(["a", "b", "c"] * 5))]
