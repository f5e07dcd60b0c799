"""Training-data pipeline over ``documents``: each stage works on all that the one before it kept.

The stages, in order: toxic documents go; of equal texts one stays; of each
group of near copies one stays; documents that hold a benchmark passage go; what is
left is encoded, and decoded again as a check.  A stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.  ``run`` writes each stage's result into the session's shared
checkpoint folder and hands the reread table on, so a stage is computed
once and a lost executor rereads the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textdims.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from textdims.llm.common import table
from textdims.llm.queries import TOXIC, bpe_digest, tokenizer
from textdims.session import materialize


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), TOXIC)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of fingerprints stays."""
    return simhash.drop_near_copies(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the decoded text."""
    return bpe_digest(bpe.encode_and_decode(docs, tokenizer("word_bpe_49k.json")), F.col("ids"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", nontoxic),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", benchmark_free),
    ("encoding", encoded),
]

#: No SQL form: toxicity is learned, fingerprints and merges are none of SQL's; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs
