"""Line dedup over windows of three consecutive lines.

Every line is hashed; three consecutive hashes make a window, windows overlap.
A window that occurs more than once in the corpus has its first occurrence
(smallest document id, then line) kept; all later ones are covered.  Lines under a
covered window go, however many windows cover them.

Windows are counted with map-side partial minima and joined back to their
occurrences; the side of repeated windows has one row for each, so a hot
window is split by the adaptive skew join.  Only covered line numbers are gathered
for each document, merged with its text at the end.

Defined cases: a null text is empty; a text of fewer than three lines has no
window and stays whole; lines end at a line feed and are compared byte by byte
(empty lines count as lines); a window may repeat, and overlap itself, within a document; rows that share
an id, null ids included, are told apart by their text's hash; repeated rows with
equal id and text lose the same lines; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_and_text, map_arrow

WINDOW = 3


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, key, line (0-based first line), h (128 bits of the window's lines)."""
    lines = rows.select("doc_id", "key", F.split("text", "\n").alias("lines")).filter(F.size("lines") >= size)
    hashed = lines.select("doc_id", "key", F.transform("lines", lambda x: F.xxhash64(x)).alias("h1"), F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("h2"))
    at = F.sequence(F.lit(0), F.size("h1") - size)
    windows = F.transform(
        at,
        lambda i: F.struct(
            i.alias("line"),
            F.xxhash64(*[F.get("h1", i + k) for k in range(size)]).alias("a"),
            F.xxhash64(*[F.get("h2", i + k) for k in range(size)]).alias("b"),
        ),
    )
    return hashed.select("doc_id", "key", F.explode(windows).alias("w")).select("doc_id", "key", "w.line", "w.a", "w.b")


def covered_lines(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, key, starts: first lines of the windows whose first occurrence is elsewhere."""
    windows = _windows(rows, size)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "key", "line")
    repeated = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").select("a", "b", "first")
    later = windows.join(repeated, ["a", "b"]).filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "key", "line")
    return later.groupBy("doc_id", "key").agg(F.collect_set("line").alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """doc_id, n_lines, n_removed, text without the covered lines."""
    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    covered = cut(covered_lines(rows, size))
    joined = rows.join(covered.withColumnRenamed("doc_id", "id").withColumnRenamed("key", "k"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k")), "left")

    def remove(batches):
        for batch in batches:
            n_lines, n_removed, texts = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                lines = text.split("\n")
                gone = {s + k for s in starts or () for k in range(size)}
                n_lines.append(len(lines))
                n_removed.append(len(gone))
                texts.append("\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_lines", "n_removed", "text"])

    return map_arrow(joined.select("doc_id", "text", "starts"), remove, "doc_id long, n_lines long, n_removed long, text string")
