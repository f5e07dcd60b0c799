"""Document x keyword matrix and pair statistics.

The long (text, var) hit table is the truth; the wide 0/1 matrix exists
only as an export (``merge_columns``), made from bitmaps.  Nothing depends on
the size of the vocabulary: joins with it are planned by its measured size, pair
counts are worked off in blocks of variables.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..functions.text import WORD_PATTERN
from .ids import sequential_ids
from .tokens import UNKNOWN_LEMMA

BLOCK = 2048  # variables on each side of a block of the Gram matrix
PAIRS = 512  # variables on each side of a block of written-out pairs
EXPORT_COLUMNS = 1000  # variables in one group of the wide export
BITMAP = 32768  # variables that one bitmap can hold


def raw_lemma(w: Column) -> Column:
    """Third column of the rule tagger (lemma as tagged, not resolved or lower-cased)."""
    return (
        F.when(w.rlike(r"[\p{N}_]"), F.lit(UNKNOWN_LEMMA))
        .when(w.rlike(r"^\p{Lu}") & (F.length(w) > 1), w)
        .otherwise(F.lower(w))
    )


def keyword_index(keywords: DataFrame, prefix: str = "v", width: int = 6) -> DataFrame:
    """Sorted distinct keywords numbered from 1 -> (var, idx, lemma)."""
    kw = keywords.select(F.trim("lemma").alias("lemma")).filter(F.col("lemma") != "").distinct()
    s = sequential_ids(kw, ["lemma"], out="idx", start=1)
    return s.select(F.concat(F.lit(prefix), F.lpad(F.col("idx").cast("string"), width, "0")).alias("var"), "idx", "lemma")


def text_keyword_hits(texts: DataFrame, index: DataFrame, text_col: str = "text", keys=("text_id", "stratum"), match: str = "raw") -> DataFrame:
    """J1 straight from the texts: distinct word forms exploded, lemma per form, join
    with the vocabulary, then a distinct over the (small) hit rows - two
    forms of a text can share a lemma.

    ``match``: ``raw`` compares the lemma as tagged, ``lower`` its lower-cased
    resolved form (the one that keyness counts).
    """
    if match not in ("raw", "lower"):
        raise ValueError("match must be 'raw' or 'lower'")
    forms = texts.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(WORD_PATTERN), 0))).alias("w"))
    lem = forms.select(*keys, (raw_lemma(F.col("w")) if match == "raw" else F.lower("w")).alias("lemma"))
    return lem.join(index, "lemma").select(*keys, "var", "idx").distinct()


def drop_zero_rows(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Texts with at least one keyword."""
    return texts.join(hits.select("text_id"), "text_id", "left_semi")


def presence_bitmaps(hits: DataFrame, columns: int = EXPORT_COLUMNS) -> DataFrame:
    """(text_id, bucket, bits): the variables of a text as bitmaps of ``columns`` variables each, buckets from 1.

    One aggregate whatever the vocabulary; a (text, bucket) without variables has no row, so zeros are never written.
    """
    if not 0 < columns <= BITMAP:
        raise ValueError(f"a bitmap holds 1 to {BITMAP} variables")
    place = (F.col("idx") - 1).cast("long")
    bucket = (F.floor(place / F.lit(columns)) + 1).cast("int")
    full = hits.select("text_id", bucket.alias("bucket"), (place % columns).alias("place")).groupBy("text_id", "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    return full.withColumn("bits", F.substring("bits", 1, (columns + 7) // 8))


def _bucket(columns: int) -> Column:
    return (F.floor((F.col("idx") - 1) / F.lit(columns)) + 1).cast("int").alias("bucket")


def _rows_with_bits(texts: DataFrame, hits: DataFrame, index: DataFrame, columns: int) -> DataFrame:
    """(text_id, bucket, size, bits): every text with every bucket, how many variables the bucket has, and its bitmap or null."""
    sizes = index.groupBy(_bucket(columns)).agg(F.count(F.lit(1)).cast("int").alias("size"))
    buckets = index.select(F.max(_bucket(columns)).alias("last")).first()["last"] or 0
    grid = texts.select("text_id", F.explode(F.sequence(F.lit(1), F.lit(buckets)) if buckets else F.array().cast("array<int>")).alias("bucket"))
    return grid.join(presence_bitmaps(hits, columns), ["text_id", "bucket"], "left").join(sizes, "bucket")


def _flags(bits: bytes | None, n: int) -> np.ndarray:
    """The first ``n`` bits of a bitmap, or zeros."""
    return np.zeros(n, np.uint8) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8)[: (n + 7) // 8], count=n, bitorder="little")


#: Rows that a task hands on at a time when it writes zeros out.
WRITTEN = 1 << 16


def presence_grid(texts: DataFrame, hits: DataFrame, index: DataFrame) -> DataFrame:
    """(text_id, var, present 0/1) for every text x keyword, for a consumer that wants zeros as rows.

    Texts meet bitmaps; the rows are written out inside a map, and get the variables' names by number.
    """

    def write(batches):
        def out(ids, idx, flags):
            return pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(idx)), pa.array(np.concatenate(flags).astype(np.int32))], ["text_id", "idx", "present"])

        for batch in batches:
            at, idx, flags, size = [], [], [], 0
            for k, (bucket, n, bits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("bucket", "size", "bits")), strict=True)):
                at.append(np.full(n, k))
                idx.append(np.arange(n, dtype=np.int64) + (bucket - 1) * EXPORT_COLUMNS + 1)
                flags.append(_flags(bits, n))
                size += n
                if size >= WRITTEN:
                    yield out(batch.column("text_id").take(pa.array(np.concatenate(at))), idx, flags)
                    at, idx, flags, size = [], [], [], 0
            if at:
                yield out(batch.column("text_id").take(pa.array(np.concatenate(at))), idx, flags)

    rows = _rows_with_bits(texts, hits, index, EXPORT_COLUMNS).select("text_id", "bucket", "size", "bits")
    cells = rows.mapInArrow(write, f"text_id {texts.schema['text_id'].dataType.simpleString()}, idx long, present int")
    return cells.join(index.select(F.col("idx").cast("long").alias("idx"), "var"), "idx").select("text_id", "var", "present")


def merge_columns(texts: DataFrame, hits: DataFrame, index: DataFrame, columns: int = EXPORT_COLUMNS) -> DataFrame:
    """(text_id, bucket, flags): the whole 0/1 matrix, a string of one character for each variable in order.

    One row for each text and bucket of ``columns`` variables; the last bucket has what is left.
    """

    def write(batches):
        for batch in batches:
            flags = [(_flags(bits, n) + 48).tobytes() for n, bits in zip(batch.column("size").to_pylist(), batch.column("bits").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("text_id"), batch.column("bucket"), pa.array(flags, pa.binary()).cast(pa.string())], ["text_id", "bucket", "flags"])

    rows = _rows_with_bits(texts, hits, index, columns).select("text_id", "bucket", "size", "bits")
    return rows.mapInArrow(write, f"text_id {texts.schema['text_id'].dataType.simpleString()}, bucket int, flags string")


def merge_column_groups(texts: DataFrame, hits: DataFrame, index: DataFrame, columns: int = EXPORT_COLUMNS) -> DataFrame:
    """C10 with the flags of each ``columns`` variables as an array: (text_id, group, flags)."""
    return merge_columns(texts, hits, index, columns).select("text_id", F.col("bucket").alias("group"), F.split("flags", "").cast("array<int>").alias("flags"))


def _gram(block: int, room: int = 1 << 21):
    """Adds up, over the texts of a task, how many hold two variables: one pass, in blocks of variables that the texts hold.

    Number 0 stands for the text itself, so its pairs are the number of texts and those that hold each variable.
    """

    def count(lists: list[np.ndarray]):
        var = np.concatenate(lists)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        part = var // block
        held = np.unique(part)
        by_block = {b: (row[part == b], var[part == b] - b * block) for b in held.tolist()}
        for n, a in enumerate(held.tolist()):
            for b in held.tolist()[n:]:
                g = np.zeros((block, block), np.int64)
                rows = np.intersect1d(by_block[a][0], by_block[b][0])
                for start in range(0, len(rows), block):
                    texts = rows[start : start + block]
                    sides = []
                    for of in {a: 0, b: 1}:
                        r, v = by_block[of]
                        at = np.minimum(np.searchsorted(texts, r), len(texts) - 1)
                        own = texts[at] == r
                        x = np.zeros((len(texts), block), np.float32)
                        x[at[own], v[own]] = 1.0
                        sides.append(x)
                    g += np.rint(sides[0].T @ sides[-1]).astype(np.int64)
                i, j = np.nonzero(g)
                n11, i, j = g[i, j], i + a * block, j + b * block
                yield pa.RecordBatch.from_arrays([pa.array(x[i <= j], pa.int64()) for x in (i, j, n11)], ["i", "j", "n11"])

    def fn(batches):
        lists, size = [], 0
        for batch in batches:
            for x in batch.column("idxs"):
                lists.append(np.r_[0, x.values.to_numpy()])
                size += len(lists[-1])
                if size > room:
                    yield from count(lists)
                    lists, size = [], 0
        if lists:
            yield from count(lists)

    return fn


def pair_counts(hits: DataFrame, block: int = BLOCK) -> DataFrame:
    """(i, j, n11) for i <= j with n11 > 0, variables by number; number 0 is every text.

    One scan of the texts' variable lists whatever the number of blocks: a task multiplies the
    indicator rows of its texts for the pairs of blocks that they hold (X_i^T X_j, at most
    block x block) and emits partial counts; one aggregate sums them.  Written once.
    """
    from ..session import materialize

    per_text = hits.groupBy("text_id").agg(F.collect_set(F.col("idx").cast("long")).alias("idxs"))
    partial = per_text.select("idxs").mapInArrow(_gram(block), "i long, j long, n11 long")
    return materialize(partial.groupBy("i", "j").agg(F.sum("n11").alias("n11")), "gram")


def cooccurrence(hits: DataFrame, index: DataFrame, n_texts=None, block: int = BLOCK, absent: bool = True) -> DataFrame:
    """(var_i, var_j, n11, n10, n01, n00) for all pairs i < j, or only those that some text holds (``absent=False``).

    Pairs that no text holds are written out from the margins, block by block of variables.
    """
    g = pair_counts(hits, block)
    if n_texts is None:
        n_texts = F.coalesce(g.filter("j = 0").select("n11").scalar(), F.lit(0))
    held = g.filter("i = 0 and j > 0").select(F.col("j").alias("k"), F.col("n11").alias("nk"))
    margins = index.select(F.col("idx").cast("long").alias("k"), "var").join(held, "k", "left").select("k", "var", F.coalesce("nk", F.lit(0)).alias("nk"))
    present = g.filter("i > 0 and i < j")
    a, b = (margins.select(*[F.col(c).alias(f"{c}_{x}") for c in ("k", "var", "nk")]) for x in "ij")
    if absent:
        size = F.lit(PAIRS)
        cells = present.select(F.floor(F.col("i") / size).alias("bi"), F.floor(F.col("j") / size).alias("bj"), "i", "j", "n11")
        blocks = margins.groupBy(F.floor(F.col("k") / size).alias("b")).agg(F.array_sort(F.collect_list(F.struct("k", "var", "nk"))).alias("m"))
        last = blocks.select(F.max("b")).scalar()
        left = blocks.select(F.col("b").alias("bi"), F.col("m").alias("mi"), F.explode(F.sequence("b", last)).alias("bj"))
        grid = left.join(blocks.select(F.col("b").alias("bj"), F.col("m").alias("mj")), "bj")
        pairs = grid.groupBy("bi", "bj").cogroup(cells.groupBy("bi", "bj")).applyInArrow(_all_pairs, "var_i string, var_j string, n11 long, ni long, nj long")
    else:
        pairs = present.join(a, F.col("i") == F.col("k_i")).join(b, F.col("j") == F.col("k_j")).select("var_i", "var_j", "n11", F.col("nk_i").alias("ni"), F.col("nk_j").alias("nj"))
    n11 = F.col("n11")
    return pairs.select("var_i", "var_j", "n11", (F.col("ni") - n11).alias("n10"), (F.col("nj") - n11).alias("n01"), (n_texts - F.col("ni") - F.col("nj") + n11).alias("n00"))


def _all_pairs(grid: pa.Table, cells: pa.Table) -> pa.Table:
    """All pairs i < j of two blocks of variables with their counts, zero where ``cells`` has none."""
    sides = []
    for c in ("mi", "mj"):
        m = grid[c].combine_chunks().flatten()
        sides.append((m.field("k").to_numpy(), m.field("var"), m.field("nk").to_numpy()))
    (ki, vi, ni), (kj, vj, nj) = sides
    n11 = np.zeros((len(ki), len(kj)), np.int64)
    n11[np.searchsorted(ki, cells["i"].to_numpy()), np.searchsorted(kj, cells["j"].to_numpy())] = cells["n11"].to_numpy()
    a, b = np.nonzero(ki[:, None] < kj[None, :])
    return pa.table({"var_i": vi.take(pa.array(a)), "var_j": vj.take(pa.array(b)), "n11": pa.array(n11[a, b]), "ni": pa.array(ni[a]), "nj": pa.array(nj[b])})


def tetrachoric(pairs: DataFrame) -> DataFrame:
    """Tetrachoric r per pair from its 2x2 counts (Arrow batches, numpy);
    empty cell -> r = 0 and ``flag`` = 1 (the method's missing -> 0 rule)."""

    def fn(batches):
        for pdf in batches:
            r = stats.tetrachoric(pdf["n11"].to_numpy(), pdf["n10"].to_numpy(), pdf["n01"].to_numpy(), pdf["n00"].to_numpy())
            flag = np.isnan(r)
            yield pd.DataFrame({"var_i": pdf["var_i"], "var_j": pdf["var_j"], "r": np.where(flag, 0.0, r), "flag": flag.astype("int32")})

    return pairs.select("var_i", "var_j", "n11", "n10", "n01", "n00").mapInPandas(fn, "var_i string, var_j string, r double, flag int")


def phi(pairs: DataFrame) -> DataFrame:
    """Pearson (phi) correlation of two 0/1 variables from the 2x2 counts."""
    n11, n10, n01, n00 = (F.col(c).cast("double") for c in ("n11", "n10", "n01", "n00"))
    num = n11 * n00 - n10 * n01
    den = F.sqrt((n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00))
    return pairs.select("var_i", "var_j", F.when(den > 0, num / den).otherwise(F.lit(0.0)).alias("r"))


def select_by_correlation(corr: DataFrame, r_min: float, top: int | None = None) -> DataFrame:
    """Variables whose largest |r| with another variable reaches ``r_min``; with ``top``, the first so many by it (ties by name)."""
    both = corr.select(F.explode(F.array(
        F.struct(F.col("var_i").alias("var"), F.abs("r").alias("ar")),
        F.struct(F.col("var_j").alias("var"), F.abs("r").alias("ar")),
    )).alias("s")).select("s.*")
    best = both.groupBy("var").agg(F.max("ar").alias("max_abs_r")).filter(F.col("max_abs_r") >= r_min)
    return best if top is None else best.orderBy(F.col("max_abs_r").desc(), "var").limit(top)
