"""Registered queries on the smallest driver tables against their DuckDB oracles."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from textdims.sources.tables import TABLES

from .conftest import SF_SMALL

FAST = ["keyness", "quota_topk", "clean_posts", "duplicate_report", "exact_dedup", "describe", "iqr_filter", "listing_limit",
        "cap_comments", "anova", "box_stats", "corpus_size", "normalize_template", "match_terms", "seq_ids", "tag_tokens",
        "box_outliers", "stage_report", "communalities", "run_counts", "comments_roundtrip", "corpus_roundtrip", "id_map_roundtrip", "matrix_roundtrip",
        "results_roundtrip", "near_dup_members", "build_prompt_guided", "merge_columns", "scree", "rotate", "tetrachoric", "anova_pvalue", "anova_table",
        "complete_job", "collect_cancel_resume", "stream_first_texts", "presence_grid", "cooccurrence"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "ll" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    scols = df.columns
    srows = sorted(tuple(_norm(r[c]) for c in sorted(scols)) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert sorted(scols) == sorted(ocols)
    assert srows == orows and srows  # an empty row would prove nothing
