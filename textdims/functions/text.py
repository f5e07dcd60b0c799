"""Scalar text / number functions as ``Column -> Column`` expressions.

All of these stay inside whole-stage codegen (built-in Spark functions
only); none of them is a Python UDF.  Patterns use explicit Unicode classes
(``\\p{L}``, ``\\p{N}``) so that the Java regex engine, Python's Unicode
``\\w`` and RE2 (used by the DuckDB oracles) agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the analysed method for identical results)
# ---------------------------------------------------------------------------
# A word is a maximal run of Unicode letters, digits and underscore
# (Python's Unicode ``\b\w+\b``).
WORD_PATTERN = r"[\p{L}\p{N}_]+"
# Unicode white space, written out: the engine's own class for it is several times slower.
SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_SPACE = "[^" + SPACE[1:]
# URLs replaced by a placeholder in template normalisation.
URL_PATTERN = rf"(https?://{NON_SPACE}+|www\.{NON_SPACE}+)"
URL_PLACEHOLDER = " URL "
NUM_PLACEHOLDER = " NUM "
# Punctuation characters whose runs collapse to one character.
COLLAPSED_PUNCTUATION = r"([!?.,])\1+"
# Re-attachment of split tokens: pattern and replacement, in this order.
REATTACHED = [
    (r"(?U)\b([A-Za-z]+)\s+n['’]t\b", "$1n't"),
    (rf"{SPACE}+([,.!?])", "$1"),
    (rf'{SPACE}+"', '"'),
    (rf'"{SPACE}+', '"'),
]
# A sentence ends at . ! ? before white space and an upper-case letter.
SENTENCE_END = rf"([.!?]){SPACE}+(?=[A-Z])"
# Length band: share below and above the original, least lower bound and least width.
BAND_LOW, BAND_HIGH, BAND_STEP = 0.8, 1.2, 10
# Critical log-likelihood of a keyword.
CRITICAL_LL = 3.84
# Replacement map used for typeset output (character -> escaped form).
TYPESET_ESCAPES = {"$": r"\$", "#": r"\#", "&": r"\&", "_": r"\_"}
# Characters removed before typesetting.
TYPESET_STRIPPED = ["{", "}", "\\"]
# Default length band when the original length is unknown.
DEFAULT_LENGTH_BAND = (120, 500)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# H1 ------------------------------------------------------------------------
def word_count(c) -> Column:
    """Number of Unicode word runs (``\\b\\w+\\b`` matches)."""
    return F.regexp_count(_c(c), F.lit(WORD_PATTERN)).cast("long")


def words(c) -> Column:
    """Array of word runs, in text order."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_PATTERN), 0)


def is_blank(c) -> Column:
    """Null, empty or whitespace-only text (Unicode whitespace)."""
    return _c(c).isNull() | ~_c(c).rlike(NON_SPACE)


# H2 ------------------------------------------------------------------------
def normalize_template(c, strip_numbers: bool = True) -> Column:
    """lower -> URL placeholder -> squash whitespace + trim -> digits -> repeated punctuation."""
    s = F.lower(_c(c))
    s = F.regexp_replace(s, URL_PATTERN, URL_PLACEHOLDER)
    s = F.trim(F.regexp_replace(s, f"{SPACE}+", " "))
    if strip_numbers:
        s = F.regexp_replace(s, r"\p{Nd}+", NUM_PLACEHOLDER)
    s = F.regexp_replace(s, COLLAPSED_PUNCTUATION, "$1")
    return s


# H3 ------------------------------------------------------------------------
def char_wb_ngrams(c, lo: int = 4, hi: int = 6) -> Column:
    """Character n-grams (lo..hi) inside space-padded words (lower-cased).

    Word = whitespace-separated run; the padded word ``' '+w+' '`` yields every
    window of length n; a padded word shorter than ``lo`` yields itself once;
    words shorter than a larger n add nothing for that n.

    Built from regex look-aheads only (whole-stage codegen, no lambdas): the
    words are laid out as `` w1  w2  w3 `` (each padded, pads adjacent), and a
    window of one padded word is exactly a string of shape
    `` x{n-1}``, `` x{n-2} ``, ``x{n}`` or ``x{n-1} `` (x = non-space); a window
    crossing two words would contain two adjacent spaces.
    """
    text = F.trim(F.regexp_replace(F.lower(_c(c)), f"{SPACE}+", " "))
    laid = F.concat(F.lit(" "), F.regexp_replace(text, " ", "  "), F.lit(" "))
    parts = []
    for n in range(lo, hi + 1):
        rx = f"(?=( [^ ]{{{n - 1}}}| [^ ]{{{n - 2}}} |[^ ]{{{n}}}|[^ ]{{{n - 1}}} ))"
        parts.append(F.regexp_extract_all(laid, F.lit(rx), 1))
    if lo > 3:
        parts.append(F.regexp_extract_all(laid, F.lit(f"(?=( [^ ]{{1,{lo - 3}}} ))"), 1))
    grams = F.concat(*parts)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(grams)


# H4 ------------------------------------------------------------------------
def resolve_lemma(word, lemma) -> Column:
    """``<unknown>`` or empty lemma -> the word form."""
    lm = F.trim(_c(lemma))
    return F.when(lm.isNull() | (lm == "") | (lm == "<unknown>"), F.trim(_c(word))).otherwise(lm)


# H6 ------------------------------------------------------------------------
def length_band(wc) -> tuple[Column, Column]:
    """(lower, upper) word band: +-20 % rounded, lower >= 10, upper >= lower + 10."""
    w = F.greatest(F.lit(1), _c(wc).cast("long"))
    lower = F.greatest(F.lit(BAND_STEP), F.round(w * BAND_LOW).cast("long"))
    upper = F.greatest(lower + BAND_STEP, F.round(w * BAND_HIGH).cast("long"))
    return lower, upper


def length_line(wc) -> Column:
    lo, hi = length_band(wc)
    d_lo, d_hi = DEFAULT_LENGTH_BAND
    return F.when(
        _c(wc).isNull(), F.lit(f"- Length: {d_lo}–{d_hi} words.\n")
    ).otherwise(F.format_string("- Length: %d–%d words.\n", lo, hi))


# H8 ------------------------------------------------------------------------
def split_prompt(c) -> tuple[Column, Column]:
    """(system, user) blocks of a built prompt; null when a block is absent."""
    s = _c(c)
    sys_ = F.regexp_extract(s, r"(?s)SYSTEM PROMPT:\s*(.+?)\nUSER PROMPT:", 1)
    usr = F.regexp_extract(s, r"(?s)USER PROMPT:\s*(.+)", 1)
    sys_ = F.when(sys_ == "", F.lit(None)).otherwise(F.trim(sys_, F.lit(" \t\n\r")))
    usr = F.when(usr == "", F.lit(None)).otherwise(F.trim(usr, F.lit(" \t\n\r")))
    return sys_, usr


# H9 ------------------------------------------------------------------------
def printed(x, digits: int) -> Column:
    """``digits`` decimals of the exact binary value, ties to even, as C and Python print it (``format_string`` rounds half up)."""
    return F.replace(F.format_number(_c(x).cast("double"), digits), F.lit(","), F.lit(""))


def fmt_loading(x) -> Column:
    """Two decimals without a leading zero: .45, -.62, 1.05."""
    return F.regexp_replace(printed(x, 2), r"^(-?)0\.", "$1.")


def fmt_r2(x) -> Column:
    """Five decimals without leading zero plus the percent with two decimals."""
    s = F.regexp_replace(printed(x, 5), r"^(-?)0\.", "$1.")
    return F.concat(s, F.lit(" ("), printed(_c(x) * 100, 2), F.lit("%)"))


# H10 -----------------------------------------------------------------------
def detokenize(tokens) -> Column:
    """Join tokens by a space and re-attach n't, punctuation and quotes."""
    t = F.array_join(_c(tokens), " ")
    for pattern, replacement in REATTACHED:
        t = F.regexp_replace(t, pattern, replacement)
    return t


# H11 -----------------------------------------------------------------------
def split_sentences(c) -> Column:
    """Split after . ! ? + whitespace when an upper-case letter follows; drop empties."""
    marked = F.regexp_replace(_c(c), SENTENCE_END, "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), strip), lambda x: x != "")


def strip(c) -> Column:
    """Text without Unicode white space at its ends (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(c), f"^{SPACE}+|{SPACE}+$", "")


# H13 -----------------------------------------------------------------------
def escape_map(c, mapping: dict | None = None, stripped: list | None = None) -> Column:
    s = _c(c)
    for ch in TYPESET_STRIPPED if stripped is None else stripped:
        s = F.replace(s, F.lit(ch), F.lit(""))
    for ch, rep in (TYPESET_ESCAPES if mapping is None else mapping).items():
        s = F.replace(s, F.lit(ch), F.lit(rep))
    return s


# H14 -----------------------------------------------------------------------
def wrap_symbols(c, prefix: str = "{\\EmojiFont ", suffix: str = "}") -> Column:
    """Wrap every Unicode 'Symbol, other' character."""
    pre = prefix.replace("\\", "\\\\").replace("$", "\\$")
    suf = suffix.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(c), r"(\p{So})", pre + "$1" + suf)


# H15 / A9 ------------------------------------------------------------------
def slug(c) -> Column:
    """Path-safe name: trim, chars other than letters/digits/-_. -> '_', strip '_', fallback 'run'."""
    s = F.regexp_replace(F.trim(_c(c)), r"[^\p{L}\p{N}\-_.]", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.when(s == "", F.lit("run")).otherwise(s)


def slug_capped(c, max_len: int = 64) -> Column:
    """Slug cut to ``max_len`` characters ending in ``_etc`` when longer."""
    s = slug(c)
    return F.when(F.length(s) > max_len, F.concat(F.substring(s, 1, max_len - 4), F.lit("_etc"))).otherwise(s)


# H16 -----------------------------------------------------------------------
def epoch_to_ts(c) -> Column:
    """Epoch seconds -> UTC timestamp; unparsable -> null."""
    return F.timestamp_seconds(F.expr(f"try_cast({_sql_name(c)} as bigint)") if isinstance(c, str) else c.try_cast("bigint"))


def _sql_name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


# H17 -----------------------------------------------------------------------
def zero_pad(n, width: int, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.lpad(_c(n).cast("string"), width, "0"))


# H17/H18/H19/H20 -----------------------------------------------------------
def log_likelihood(a, b, c, d) -> Column:
    """2*(a ln(a/E1) + b ln(b/E2)), 0 when a = 0 or b = 0."""
    a, b, c, d = (_c(x).cast("double") for x in (a, b, c, d))
    e1 = c * (a + b) / (c + d)
    e2 = d * (a + b) / (c + d)
    ll = 2.0 * (a * F.log(a / e1) + b * F.log(b / e2))
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(ll)


def pct_diff(pa, pb) -> Column:
    pa, pb = _c(pa), _c(pb)
    return F.when((pa + pb) == 0, F.lit(0.0)).otherwise(100.0 * (pa - pb) / ((pa + pb) / 2.0))


def keyness_status(ll, diff, critical: float = CRITICAL_LL) -> Column:
    ll, diff = _c(ll), _c(diff)
    return (
        F.when((ll >= critical) & (diff > 0), F.lit("POSKW"))
        .when(ll >= critical, F.lit("NEGKW"))
        .otherwise(F.lit("NOTKW"))
    )


# H21 -----------------------------------------------------------------------
def label_text(word, var_id, full: bool = False) -> Column:
    """Label of a variable: ``word`` or ``word (v000001)``; double quotes doubled."""
    w = F.replace(_c(word), F.lit('"'), F.lit('""'))
    if full:
        return F.concat(w, F.lit(" ("), _c(var_id), F.lit(")"))
    return w


# B17 -----------------------------------------------------------------------
def preview(c, n: int = 300) -> Column:
    """Squash whitespace runs to one space, first n characters."""
    return F.substring(F.regexp_replace(_c(c), f"{SPACE}+", " "), 1, n)


# B18 / B19 / B20 -----------------------------------------------------------
def stratum_source(folder) -> Column:
    return F.when(_c(folder) == "human", F.lit("human")).otherwise(F.lit("ai"))


def stratum_prompt(folder) -> Column:
    f = _c(folder)
    return (
        F.when(f == "human", F.lit("human"))
        .when(f.startswith("generic_"), F.lit("generic"))
        .when(f.startswith("summary_guided_"), F.lit("summary_guided"))
        .otherwise(F.lit("unknown"))
    )


def stratum_model(folder) -> Column:
    f = _c(folder)
    return F.when(f == "human", F.lit("human")).otherwise(F.lower(F.element_at(F.split(f, "_"), -1)))


def derive_group(source, prompt, model) -> Column:
    return F.when(_c(source) == "human", F.lit("human")).otherwise(F.concat_ws("_", _c(prompt), _c(model)))


def derive_season(stem) -> Column:
    two = F.substring(_c(stem), 2, 2)
    return F.when(two.rlike(r"^[0-9]{2}$"), two).otherwise(F.lit("unknown"))


# B21 -----------------------------------------------------------------------
def normalize_level(c, lower: bool = True) -> Column:
    return F.lower(F.trim(_c(c))) if lower else F.trim(_c(c))
