"""Tagged tokens (P1), content-token filter (B12) and the per-text lemma sets.

The tagger is a rule on the word form alone (suffix rules); an optional
lexicon DataFrame ``(form, tag, lemma)`` overrides it through a join that
Catalyst/AQE plans (broadcast only when the lexicon is measured small).
Because the rule needs no context, per-text lemma sets are built inside
each row with array functions: no shuffle before the first aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN, resolve_lemma

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Token = word run or one other non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
# Content tags kept for keyness: nouns, proper nouns, verbs, adjectives.
CONTENT_TAG_PREFIXES = ("NN", "NP", "VB", "JJ")
# Lemmas never counted.
STOP_LEMMAS = ("be", "have", "do")
# Suffix rules of the built-in tagger (tag, word endings on the lower-cased form); first match wins.
SUFFIX_RULES = (
    ("VBG", ("ing",)),
    ("VBD", ("ed",)),
    ("RB", ("ly",)),
    ("JJ", ("ous", "ful", "ive", "able", "ible", "al", "ic")),
)
SHORT_WORD_TAG = "IN"  # forms of at most 3 characters
DEFAULT_TAG = "NN"
UNKNOWN_LEMMA = "<unknown>"


def _suffix_tag(form: Column) -> Column:
    """Tag implied by the word ending, null if none; a word has one of the endings at most."""
    lower = F.lower(form)
    e = F.when(F.lit(False), F.lit(None))
    for tag, xs in SUFFIX_RULES:
        e = e.when(_ends(lower, xs), F.lit(tag))
    return e


def tag_of(form: Column) -> Column:
    """Rule tag of one token form.  No rule on numbers, signs or capitals meets a form that starts with a to z: nearly all forms need no regular expression."""
    other, n = ~((form >= "a") & (form < "{")), F.length(form)
    return (
        F.when(other & form.rlike(r"^\p{N}+$"), F.lit("CD"))
        .when(other & form.rlike(r"^[.!?]$"), F.lit("SENT"))
        .when(other & (n <= 2) & form.rlike(r"^[^\p{L}\p{N}_]$"), F.lit("PUN"))
        .when(other & (n > 1) & form.rlike(r"^\p{Lu}"), F.lit("NP"))
        .otherwise(F.coalesce(_suffix_tag(form), F.when(F.length(form) <= 3, F.lit(SHORT_WORD_TAG)).otherwise(F.lit(DEFAULT_TAG))))
    )


def lemma_of(form: Column, tag: Column) -> Column:
    """Rule lemma: ``<unknown>`` for forms with digits/underscore, proper nouns keep case."""
    return (
        F.when(form.rlike(r"[\p{N}_]"), F.lit(UNKNOWN_LEMMA))
        .when(tag == "NP", form)
        .otherwise(F.lower(form))
    )


def content_lemma(word: Column, tag: Column, lemma: Column) -> Column:
    """B12 + H4: lower-cased resolved lemma of a content token, else null."""
    lm = F.lower(resolve_lemma(word, lemma))
    content = reduce(or_, [tag.startswith(x) for x in CONTENT_TAG_PREFIXES])
    return F.when(content & ~lm.isin(*STOP_LEMMAS) & lm.rlike(r"(?s)\p{L}.*\p{L}"), lm)


def tag_tokens(texts: DataFrame, text_col: str = "text", keys=("text_id",), lexicon: DataFrame | None = None) -> DataFrame:
    """Text -> one row per token (keys..., pos, word, tag, lemma)."""
    toks = texts.select(
        *keys, F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_PATTERN), 0)).alias("pos", "word")
    )
    tagged = toks.withColumn("tag", tag_of(F.col("word")))
    tagged = tagged.withColumn("lemma", lemma_of(F.col("word"), F.col("tag")))
    if lexicon is not None:
        lx = lexicon.select(F.col("form").alias("_form"), F.col("tag").alias("_tag"), F.col("lemma").alias("_lemma"))
        tagged = (
            tagged.join(lx, tagged.word == lx._form, "left")
            .withColumn("tag", F.coalesce("_tag", "tag"))
            .withColumn("lemma", F.coalesce("_lemma", "lemma"))
            .drop("_form", "_tag", "_lemma")
        )
    return tagged


def content_tokens(tokens: DataFrame) -> DataFrame:
    """B12 on a tagged-token table: keep content tokens, add ``lemma_lc``.

    The rows come from a list of the one lemma or none: a filter would work out tag and lemma a second time.
    """
    lemma = content_lemma(F.col("word"), F.col("tag"), F.col("lemma"))
    return tokens.select("*", F.explode(F.array_compact(F.array(lemma))).alias("lemma_lc"))


#: Endings of content tags and of the others; no ending of one kind ends in one of the other kind, so their order plays no part.
_CONTENT_ENDINGS = tuple(x for tag, xs in SUFFIX_RULES if tag.startswith(CONTENT_TAG_PREFIXES) for x in xs)
_OTHER_ENDINGS = tuple(x for tag, xs in SUFFIX_RULES if not tag.startswith(CONTENT_TAG_PREFIXES) for x in xs)
#: Last letters of the other endings, also as capitals (no further capital has one of them as its small letter).
_OTHER_LAST = tuple(sorted({c for x in _OTHER_ENDINGS for c in (x[-1], x[-1].upper())}))
assert not any(a.endswith(b) or b.endswith(a) for a in _CONTENT_ENDINGS for b in _OTHER_ENDINGS)


def _ends(form: Column, endings) -> Column:
    return reduce(or_, [form.endswith(x) for x in endings])


def _tagged_content(lemma: Column, n: Column) -> Column:
    """Whether the tag rules give a word run of ``n`` characters a content tag without its capital: a VB*/JJ ending, or no other ending and longer than 3 characters."""
    return ((n > 3) & ~_ends(lemma, _OTHER_ENDINGS)) | _ends(lemma, _CONTENT_ENDINGS)


def _form_length(lemma: Column) -> Column:
    """Characters of the form that a lemma was: lower-casing lengthens the dotted capital I alone, by a sign that no word run has."""
    dot = "\u0307"
    return F.when(lemma.contains(dot), F.length(F.replace(lemma, F.lit(dot), F.lit("")))).otherwise(F.length(lemma))


#: Before a word of ``text_words`` that has a content tag by its capital alone; no word run has it.
CAPITAL = " "


def text_words(texts: DataFrame, text_col: str = "text", keys=("text_id", "stratum")) -> DataFrame:
    """Per-text distinct lower-cased word runs (keys..., word), computed row-locally, before any content test.

    A word that stands with a capital in the text, and would have no content tag without it,
    comes a second time, after ``CAPITAL``.  So the content test (``content_lemmas``) needs the word
    alone and may follow the counts of the words, on far fewer rows.
    """
    forms = texts.select(*keys, F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(WORD_PATTERN), 0)).alias("_forms"))

    def proper(w):
        n = F.length(w)
        # only short forms and those of another ending lack a content tag; the last letters leave few forms to lower-case
        few = (n > 1) & ((n <= 3) | _ends(w, _OTHER_LAST))
        return ~((w >= "a") & (w < "{")) & few & ~_tagged_content(F.lower(w), n) & w.rlike(r"^\p{Lu}")

    marked = F.transform(F.filter("_forms", proper), lambda w: F.concat(F.lit(CAPITAL), F.lower(w)))
    words = F.concat(F.array_distinct(F.transform("_forms", F.lower)), F.array_distinct(marked))
    return forms.select(*[c for c in forms.columns if c != "_forms"], F.explode(words).alias("word"))


def content_lemmas(words: DataFrame, count_col: str | None = None) -> DataFrame:
    """Rows of ``text_words``, or counts of them (in ``count_col``, all positive): those of content lemmas, ``lemma`` in place of ``word``; one row for each of a text's lemmas.

    With the rule tagger the resolved lemma of a word run is always ``lower(w)``
    (``<unknown>`` falls back to the form, proper nouns keep case before the
    lower-casing), so the test needs the tag class only: a proper noun, or a content tag by the
    lemma itself; then at least two letters (which no number has) and not a stop lemma.  A lemma
    that has its tag by itself is taken from its unmarked row, any other from its marked one.
    """
    rows = words.select(F.ltrim("word").alias("lemma"), F.col("word").startswith(CAPITAL).alias("_proper"), *[c for c in words.columns if c != "word"])
    lemma = F.col("lemma")
    content = (F.col("_proper") != _tagged_content(lemma, _form_length(lemma))) & ~lemma.isin(*STOP_LEMMAS) & lemma.rlike(r"\p{L}.*\p{L}")
    # a condition on the word alone would be moved before the counts, to every word of every text
    return rows.filter(content if count_col is None else F.when(F.col(count_col) > 0, content)).drop("_proper")


def text_lemmas(texts: DataFrame, text_col: str = "text", keys=("text_id", "stratum")) -> DataFrame:
    """Per-text distinct content lemmas (keys..., lemma), computed row-locally.

    Equivalent to ``content_tokens(tag_tokens(...)).select(keys, lemma_lc).distinct()``
    for word tokens, but without materialising tokens or shuffling for the
    distinct: the distinct forms of each text are found once, inside the row.
    """
    rows = content_lemmas(text_words(texts, text_col, keys))
    return rows.select(*[c for c in rows.columns if c != "lemma"], "lemma")
