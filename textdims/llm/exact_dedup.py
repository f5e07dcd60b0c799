"""Exact dedup by distributed MSD radix partitioning.

Texts are split by successive byte strings, most significant first.  The first
digit is the byte length with the first bytes; every later round splits each
open group by its next bytes.  A group of one row, or one whose texts have
ended, is finished.  Digits get longer from round to round (``DIGITS``, then
the last one repeats), so that the rounds grow with the logarithm of the
length of the longest copied text and not with its length.  Equality comes from
the bytes alone; a digest is only returned, never compared.

Every round counts its groups with map-side partial sums (count, largest id)
and joins them back to the rows; the group side is small, so a hot group is
split by the adaptive skew join.  Rows are cut from their lineage in the shared
checkpoint folder, with the text of open groups only.

Defined cases: a null text is empty; empty texts are equal to each other; a
null id ranks below every other id and rows that share the largest id of their
group are all marked as kept (``drop_copies`` leaves one of them); repeated rows are counted each; an empty table gives no rows;
other columns of the input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, one_of_repeats

#: Bytes in the digit of each round; the last repeats until every group has ended.
DIGITS = (64, 1 << 10, 1 << 14, 1 << 18, 1 << 22)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` does just that on a text of single-byte characters)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digits: tuple[int, ...] = DIGITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each input row."""
    norm = id_and_text(docs, id_col, text_col).select("doc_id", ascii_lower(F.col("text")).cast("binary").alias("rest"))
    rows = norm.select("doc_id", F.sha2("rest", 256).alias("text_sha256"), F.octet_length("rest").cast("long").alias("g"), "rest")
    done, level = [], 0
    while True:
        size = digits[min(level, len(digits) - 1)]
        keyed = rows.withColumn("digit", F.substring("rest", 1, size))
        groups = keyed.groupBy("g", "digit").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
        if level == 0:
            # most texts are alone here: only groups of several rows get a number
            groups = groups.filter(F.col("group_size") > 1)
        groups = cut(groups.withColumn("next", F.monotonically_increasing_id()))
        open_ = (F.col("group_size") > 1) & (F.octet_length("rest") > size)
        split = keyed.join(groups, ["g", "digit"], "left" if level == 0 else "inner").select(
            "doc_id",
            "text_sha256",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(open_, F.col("next")).alias("g"),
            F.when(open_, F.expr(f"substring(rest, {size + 1})")).alias("rest"),
        )
        split = cut(split)
        done.append(split.filter(F.col("g").isNull()).select("doc_id", "keep_id", "group_size", "text_sha256"))
        rows = split.filter(F.col("g").isNotNull()).select("doc_id", "text_sha256", "g", "rest")
        level += 1
        if rows.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each group: the largest id, and any one of the rows that share it."""
    copies = dedup_groups(docs, id_col, text_col).filter("group_size > 1").groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__key"))
    copies = cut(copies.agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    norm = ascii_lower(F.coalesce(docs[text_col].cast("string"), F.lit("")))

    def same(side):
        return docs[id_col].cast("long").eqNullSafe(side["__id"]) & (F.sha2(norm.cast("binary"), 256) == side["__key"])

    gone = copies.filter("not kept or n > 1").select("__id", "__key")
    repeats = copies.filter("kept and n > 1").select("__id", "__key")
    rest = docs.join(gone, same(gone), "left_anti")
    if repeats.isEmpty():
        return rest
    return rest.unionAll(one_of_repeats(docs, repeats, same(repeats)))
