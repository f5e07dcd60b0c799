"""Language identification as a Spark job (P2, H5): character n-gram profiles + argmax.

Profiles are trained from labelled rows: log P(gram | language) with add-one
smoothing over the profile vocabulary.  A text's score for a language is
N * default_l + sum over its grams seen in l of (log p - default_l), so
only seen grams add something.

Grams of three characters fit a number (21 bits each), so they are counted inside
the row, in Arrow batches: training shuffles the counts of each task only, detection
nothing at all.  The profile, whose size is that of the gram alphabet and not of the
corpus, is broadcast while it has at most ``PROFILE_ROWS`` rows; a larger one, or
longer grams, are joined by gram, where AQE splits a frequent one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, char_wb_ngrams

NGRAM = 3
UNKNOWN = "unknown"
#: Rows of a profile that may be broadcast (16 bytes each); different grams that a task counts before it sends them.
PROFILE_ROWS, COUNTED = 1 << 21, 1 << 18


def _laid_out(text_col: str):
    """The text in lower case, its words separated by single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.col(text_col)), f"{SPACE}+", " "))


def gram_codes(text: str) -> np.ndarray:
    """The three-character windows of the padded words of a text, as numbers."""
    if not text:
        return np.zeros(0, np.int64)
    c = np.frombuffer((" " + text.replace(" ", "  ") + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
    inside = np.flatnonzero(c[1:-1] != 32)  # only the ends of a window may be the padding
    return (c[inside] << 42) | (c[inside + 1] << 21) | c[inside + 2]


def _gram(code: int) -> str:
    return chr(code >> 42) + chr(code >> 21 & 0x1FFFFF) + chr(code & 0x1FFFFF)


def _code(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def language_profiles(labelled: DataFrame, id_col: str = "id", text_col: str = "text", lang_col: str = "lang", n: int = NGRAM) -> DataFrame:
    """(lang, gram, logp, default): smoothed log-probabilities of each seen gram."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if n != NGRAM:
        g = rows.select(F.col(lang_col).alias("lang"), F.explode(char_wb_ngrams(F.col(text_col), n, n)).alias("gram"))
        return _profiles(g.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")))

    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for lang, codes in held.items():
                grams, c = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array([_gram(x) for x in grams.tolist()], pa.string()), pa.array(c, pa.int64())], ["lang", "gram", "c"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                codes = gram_codes(text)
                held.setdefault(lang, []).append(codes)
                size += len(codes)
                if size > 32 * COUNTED:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = rows.select(F.col(lang_col).cast("string").alias("lang"), _laid_out(text_col).alias("text")).mapInArrow(run, "lang string, gram string, c long")
    return _profiles(counted.groupBy("lang", "gram").agg(F.sum("c").alias("c")))


def _profiles(counts: DataFrame) -> DataFrame:
    from ..session import materialize

    counts = materialize(counts, "gram-counts")
    vocab = counts.select(F.count_distinct("gram")).scalar()
    tot = counts.groupBy("lang").agg(F.sum("c").alias("t"))
    tmap = tot.select(F.map_from_entries(F.collect_list(F.struct("lang", "t")))).scalar()
    t = F.element_at(tmap, F.col("lang")).cast("double")
    return counts.select(
        "lang", "gram",
        F.log((F.col("c") + 1.0) / (t + vocab)).alias("logp"),
        F.log(1.0 / (t + vocab)).alias("default"),
    )


def detect_language(df: DataFrame, profiles: DataFrame, id_col: str = "id", text_col: str = "text", n: int = NGRAM) -> DataFrame:
    """(id, language): argmax over languages (ties -> smaller code); blank/null text -> 'unknown'."""
    from ..session import materialize

    profiles = materialize(profiles, "language-profile")
    sizes = profiles.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("lang").alias("langs")).first()
    if not sizes["rows"]:
        return df.select(F.col(id_col).alias("id"), F.lit(UNKNOWN).alias("language"))
    if n != NGRAM or sizes["rows"] * sizes["langs"] > PROFILE_ROWS:
        return _detect_by_join(df, profiles, id_col, text_col, n)
    table = profiles.toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    codes, row = np.unique(np.array([_code(g) for g in table["gram"].to_pylist()], np.int64), return_inverse=True)
    column = np.searchsorted(np.array(langs, object), np.array(table["lang"].to_pylist(), object))
    default = np.zeros(len(langs))
    default[column] = table["default"].to_numpy()
    gain = np.zeros((len(codes), len(langs)))
    gain[row, column] = table["logp"].to_numpy() - table["default"].to_numpy()
    held = df.sparkSession.sparkContext.broadcast((langs, codes, gain, default))

    def run(batches):
        langs, codes, gain, default = held.value
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                grams, c = np.unique(gram_codes(text or ""), return_counts=True)
                if not len(grams):
                    out.append(UNKNOWN)
                    continue
                at = np.minimum(np.searchsorted(codes, grams), len(codes) - 1)
                seen = codes[at] == grams
                out.append(langs[int(np.argmax(c.sum() * default + c[seen] @ gain[at[seen]]))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], ["id", "language"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), _laid_out(text_col).alias("text")).mapInArrow(run, f"id {kind}, language string")


def _detect_by_join(df: DataFrame, profiles: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``detect_language`` for profiles of any size: grams joined with the profile, partial sums of each text."""
    from ..session import materialize

    # one row for each language
    defaults = {r["lang"]: r["default"] for r in profiles.select("lang", "default").distinct().orderBy("lang").collect()}
    langs = sorted(defaults)
    gain = F.col("logp") - F.col("default")
    wide = profiles.groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == x, gain)).alias(f"g{i}") for i, x in enumerate(langs)])
    wide = materialize(wide, "language-grams")
    grams = df.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.explode(char_wb_ngrams(F.col(text_col), n, n)).alias("gram"))
    sums = grams.join(wide, "gram", "left").groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(f"g{i}"), F.lit(0.0)).alias(f"g{i}") for i in range(len(langs))])
    scores = [F.struct((-(F.col("n") * F.lit(defaults[x]) + F.col(f"g{i}"))).alias("s"), F.lit(x).alias("lang")) for i, x in enumerate(langs)]
    best = sums.select("id", F.array_min(F.array(*scores))["lang"].alias("language"))
    return df.select(F.col(id_col).alias("id")).join(best, "id", "left").select("id", F.coalesce("language", F.lit(UNKNOWN)).alias("language"))


def train_and_detect(df: DataFrame, id_col: str = "id", text_col: str = "text", lang_col: str = "lang", n: int = NGRAM, train=None) -> DataFrame:
    """Profiles from the labelled rows that ``train`` allows (a condition; all by default), detection on all rows."""
    labelled = df if train is None else df.filter(train)
    return detect_language(df, language_profiles(labelled.filter(F.col(text_col).isNotNull()), id_col, text_col, lang_col, n), id_col, text_col, n)
