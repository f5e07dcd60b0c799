"""Listing limits, comment caps, earliest representative, ids, term matching, distributed rank."""

import re

from pyspark.sql import functions as F

from textdims.operators import clean as C
from textdims.operators import ids as I
from textdims.operators import listing as L
from textdims.operators import matrix as M


def test_listing_limit_new_and_top(spark):
    rows = [(1, "a", 10, 5.0), (2, "a", 30, 1.0), (3, "a", 20, 9.0), (4, "b", 5, 2.0)]
    df = spark.createDataFrame(rows, "id long, subreddit string, created_utc long, score double")
    new = sorted(r.id for r in L.listing_limit(df, 1, "new").collect())
    top = sorted(r.id for r in L.listing_limit(df, 1, "top").collect())
    assert new == [2, 4] and top == [3, 4]
    assert L.listing_limit(df, None).count() == 4


def test_cap_comments(spark):
    rows = [("c1", "p1", 3), ("c2", "p1", 1), ("c3", "p1", 2), ("c4", "p2", 1)]
    df = spark.createDataFrame(rows, "id string, link_id string, created_utc long")
    assert sorted(r.id for r in L.cap_comments(df, 2).collect()) == ["c2", "c3", "c4"]
    assert L.cap_comments(df, 0).count() == 0
    assert L.cap_comments(df, None).count() == 4


def test_keep_earliest_and_dedup(spark):
    rows = [(1, 10, 0), (2, 5, 0), (3, 5, 0), (4, 1, None), (5, 7, 9)]
    df = spark.createDataFrame(rows, "id long, created_utc long, template_group long")
    assert sorted(r.id for r in C.keep_earliest(df, "template_group").collect()) == [2, 4, 5]
    t = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "id long, selftext string")
    assert sorted(r.id for r in C.exact_dedup(t, "selftext").collect()) == [1, 2, 4]
    rep = {r.id: r.text_count for r in C.duplicate_report(t, "selftext").collect()}
    assert rep == {1: 2, 3: 2}


def test_sequential_ids_total_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = I.formatted_ids(df, ["k"], "tid", "t", 6, start=1)
    got = {r.k: r.tid for r in out.collect()}
    assert got[0] == "t000001" and got[999] == "t001000" and len(set(got.values())) == 1000


def test_match_terms_whole_words(spark):
    df = spark.createDataFrame([(1, "Template and AGENDA, agenda!"), (2, "templates only"), (3, "a discord-server")], "id long, t string")
    got = {r.id: r.matched_terms for r in C.match_terms(df, "t", ["template", "agenda", "discord"]).collect()}
    assert got == {1: ["agenda", "template"], 3: ["discord"]}
    got2 = {r.id: r.matched_terms for r in C.match_terms(df, "t", ["discord-server"]).collect()}
    assert got2 == {3: ["discord-server"]}


def test_normalize_comment_link_prefix(spark):
    raw = spark.createDataFrame([("c", "t3_t3_x", "t1_y")], "id string, link_id string, parent_id string")
    r = L.normalize_comment(raw).collect()[0]
    assert (r.link_id, r.parent_id, r.created_utc) == ("x", "t1_y", 0)


def test_duplicates_do_not_shuffle_texts(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id long, selftext string")
    for out in (C.exact_dedup(df, "selftext").select("id"), C.duplicate_report(df, "selftext").select("id", "text_count"), C.distinct_count(df, "selftext")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        # an attribute that holds the hash is named after it
        assert not [x for x in plan.splitlines() if "Exchange" in x and "selftext" in re.sub(r"unhex\(.*?\)#\d+", "", x)]


def test_cleaning_report_in_one_pass(spark):
    rows = [(1, "one two three"), (2, "one two three"), (3, " "), (4, None), (5, "short"), (6, "a b c d")]
    got = [(r.stage, r.rows, r.removed) for r in C.cleaning_report(spark.createDataFrame(rows, "id long, t string"), "t", 3).orderBy("step").collect()]
    assert got == [("read", 6, None), ("drop_blank", 4, 2), ("exact_dedup", 3, 1), ("min_words", 2, 1)]


def test_cooccurrence_beyond_one_block(spark):
    p = 5001
    index = spark.range(1, p + 1).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("var"), F.col("id").alias("idx"), F.col("id").cast("string").alias("lemma"))
    texts = {1: [1, 2, 2500, 5001], 2: [2, 5001], 3: [2500], 4: [1, 5001]}
    hits = spark.createDataFrame([(t, i) for t, xs in texts.items() for i in xs], "text_id long, idx long").join(index, "idx")
    co = M.cooccurrence(hits, index).filter("n11 > 0")
    got = {(r.var_i, r.var_j): (r.n11, r.n10, r.n01, r.n00) for r in co.collect()}
    want = {}
    for i in (1, 2, 2500, 5001):
        for j in (1, 2, 2500, 5001):
            both = sum(i in x and j in x for x in texts.values())
            if i < j and both:
                a, b = (sum(k in x for x in texts.values()) for k in (i, j))
                want[(f"v{i:06d}", f"v{j:06d}")] = (both, a - both, b - both, 4 - a - b + both)
    assert got == want


def test_wide_export_in_groups(spark):
    index = spark.createDataFrame([("v000001", 1, "a"), ("v000002", 2, "b"), ("v000003", 3, "c")], "var string, idx long, lemma string")
    hits = spark.createDataFrame([(1, "v000001", 1), (1, "v000003", 3), (2, "v000002", 2)], "text_id long, var string, idx long")
    texts = spark.createDataFrame([(1,), (2,), (3,)], "text_id long")
    groups = sorted(tuple(r) for r in M.merge_column_groups(texts, hits, index, 2).collect())
    assert groups == [(1, 1, [1, 0]), (1, 2, [1]), (2, 1, [0, 1]), (2, 2, [0]), (3, 1, [0, 0]), (3, 2, [0])]
    assert sorted(tuple(r) for r in M.merge_columns(texts, hits, index).collect()) == [(1, 1, "101"), (2, 1, "010"), (3, 1, "000")]
    # zeros have no bitmap
    assert M.presence_bitmaps(hits, 2).count() == 3
    grid = {(r.text_id, r.var): r.present for r in M.presence_grid(texts, hits, index).collect()}
    assert len(grid) == 9 and {k for k, x in grid.items() if x} == {(1, "v000001"), (1, "v000003"), (2, "v000002")}
    assert M.merge_columns(texts, hits.limit(0), index.limit(0)).count() == 0


def test_pair_counts_of_many_blocks(spark, monkeypatch):
    """One pass in 3 and in 30 blocks gives the counts of all pairs, with and without those that no text holds."""
    import random

    from textdims.operators import matrix

    rng = random.Random(1)
    p, texts = 60, {t: sorted(rng.sample(range(1, 55), rng.randrange(1, 9))) for t in range(150)}
    index = spark.createDataFrame([(f"v{k:06d}", k, "x") for k in range(1, p + 1)], "var string, idx int, lemma string")
    hits = spark.createDataFrame([(t, f"v{k:06d}", k) for t, ks in texts.items() for k in ks], "text_id long, var string, idx int").repartition(5)
    n = {k: sum(k in ks for ks in texts.values()) for k in range(1, p + 1)}
    want = {}
    for i in range(1, p + 1):
        for j in range(i + 1, p + 1):
            both = sum(i in ks and j in ks for ks in texts.values())
            want[f"v{i:06d}", f"v{j:06d}"] = (both, n[i] - both, n[j] - both, 150 - n[i] - n[j] + both)
    monkeypatch.setattr(matrix, "PAIRS", 7)
    for block in (2, 20, 100):
        got = {(r.var_i, r.var_j): (r.n11, r.n10, r.n01, r.n00) for r in M.cooccurrence(hits, index, block=block).collect()}
        assert got == want
        held = {(r.var_i, r.var_j): (r.n11, r.n10, r.n01, r.n00) for r in M.cooccurrence(hits, index, block=block, absent=False).collect()}
        assert held == {k: v for k, v in want.items() if v[0]}
    assert len(M.cooccurrence(hits.limit(0), index).collect()) == p * (p - 1) // 2


def test_one_scan_for_any_number_of_blocks(spark):
    hits = spark.createDataFrame([(1, "v000001", 1)], "text_id long, var string, idx int")
    fn = M._gram(2, room=4)
    import pyarrow as pa

    lists = pa.array([[1, 2, 9], [2, 9], [5], []], pa.list_(pa.int64()))
    got: dict = {}
    for batch in fn([pa.RecordBatch.from_arrays([lists], ["idxs"])]):
        for i, j, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            got[i, j] = got.get((i, j), 0) + c
    assert got == {(0, 0): 4, (0, 1): 1, (1, 1): 1, (0, 2): 2, (2, 2): 2, (1, 2): 1, (0, 9): 2, (9, 9): 2, (1, 9): 1, (2, 9): 2, (0, 5): 1, (5, 5): 1}
    assert M.pair_counts(hits).count() == 3


def test_tetrachoric_solves_its_equation():
    import numpy as np

    from textdims.functions import stats

    rng = np.random.default_rng(0)
    n = rng.integers(1, 500, size=(4, 400)).astype(float)
    n[:, :100] *= np.array([[30.0], [1], [1], [30]])
    r = stats.tetrachoric(*n)
    total = n.sum(axis=0)
    h, k = stats.norm_ppf((n[0] + n[1]) / total), stats.norm_ppf((n[0] + n[2]) / total)
    inner = np.abs(r) < 0.9999
    assert np.abs(stats.bvn_cdf(h, k, r) - n[0] / total)[inner].max() < 1e-12
    assert (np.sign(r) == np.sign(n[0] * n[3] - n[1] * n[2]))[np.abs(n[0] * n[3] - n[1] * n[2]) > 1].all()


def test_match_rule_of_the_matrix(spark):
    texts = spark.createDataFrame([(1, "s", "Berlin berlin x9"), (2, "s", "Berlin")], "text_id long, stratum string, text string")
    index = spark.createDataFrame([("v000001", 1, "berlin"), ("v000002", 2, "Berlin")], "var string, idx long, lemma string")
    raw = sorted((r.text_id, r.var) for r in M.text_keyword_hits(texts, index).collect())
    low = sorted((r.text_id, r.var) for r in M.text_keyword_hits(texts, index, match="lower").collect())
    assert raw == [(1, "v000001"), (1, "v000002"), (2, "v000002")] and low == [(1, "v000001"), (2, "v000001")]


def test_wide_export_has_every_variable(spark, monkeypatch):
    """The registered export holds all variables in groups, with the flags of the hit table."""
    from textdims.operators import matrix
    from textdims.plans import QUERIES

    from .conftest import SF_SMALL

    monkeypatch.setattr(matrix.merge_column_groups, "__defaults__", (40,))
    hits = {(r.text_id, r.var) for r in QUERIES["keyword_matrix"](spark, SF_SMALL).collect()}
    names = [r.var for r in QUERIES["keyword_index"](spark, SF_SMALL).orderBy("idx").collect()]
    rows = {(r.text_id, r.group): r.flags for r in QUERIES["merge_column_groups"](spark, SF_SMALL).collect()}
    groups = range(1, -(-len(names) // 40) + 1)
    assert len(names) > 50 and set(rows) == {(i, g) for i, _ in hits for g in groups}
    got = {(i, names[(g - 1) * 40 + k]) for (i, g), flags in rows.items() for k, x in enumerate(flags) if x}
    assert got == hits and all(sum(len(rows[i, g]) for g in groups) == len(names) for i, _ in hits)


def test_pipeline_report_of_any_chain(spark):
    from textdims.operators import clean as C

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, " "), (5, "b c")], "id long, t string")
    stages = [("blank", lambda d: C.drop_blank(d, "t")), ("dedup", lambda d: C.exact_dedup(d, "t")), ("none", lambda d: d.filter("id > 100")), ("still none", lambda d: d)]
    for before in ((), ("dedup", "none")):
        result, report = C.pipeline_report(df, stages, before)
        assert result.count() == 0
        assert [tuple(r) for r in report.orderBy("step").collect()] == [(0, "read", 5, None), (1, "blank", 3, 2), (2, "dedup", 2, 1), (3, "none", 0, 2), (4, "still none", 0, 0)]
    result, report = C.pipeline_report(df, [])
    assert result.count() == 5 and report.count() == 1


def test_small_tables_are_dealt_over_the_cores(spark, monkeypatch, tmp_path):
    from textdims.sources import tables

    path = str(tmp_path / "t.parquet")
    spark.range(1000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert tables.spread(df) is df  # too small to matter
    monkeypatch.setattr(tables, "SPREAD_BYTES", 0)
    dealt = tables.spread(df)
    assert dealt.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism and sorted(r.id for r in dealt.collect()) == list(range(1000))
    spark.range(1000).repartition(2 * spark.sparkContext.defaultParallelism).write.parquet(path + "2")
    many = spark.read.parquet(path + "2")
    assert tables.spread(many) is many  # as many row groups as cores
    assert tables.spread(df.limit(0)).count() == 0


def test_content_tokens_work_out_a_tag_once(spark):
    from textdims.operators import tokens as T

    df = spark.createDataFrame([(1, "The Cats were running quickly to 42 famous x9 Übung, é aé Ünited I _b be! ..."), (2, None)], "text_id long, text string")
    tagged = T.tag_tokens(df)
    got = {r.word: r.tag for r in tagged.collect()}
    assert got["42"] == "CD" and got["!"] == "SENT" and got[","] == "PUN" and got["Cats"] == got["Übung"] == "NP"
    assert got["running"] == "VBG" and got["quickly"] == "RB" and got["famous"] == "JJ" and got["were"] == "NN" and got["to"] == got["I"] == got["é"] == "IN"
    content = T.content_tokens(tagged)
    assert [r.lemma_lc for r in content.orderBy("pos").collect()] == ["the", "cats", "were", "running", "famous", "übung", "ünited"]
    plan = content._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter isnotnull(CASE" not in plan and plan.count("RLIKE") <= 15


def test_gram_sizes_of_ids_that_come_twice(spark):
    from textdims.functions import text as H
    from textdims.operators import clean as C

    rows = [(1, "abcd abcd"), (2, "abcd"), (2, "bcd abcd"), (None, "abc"), (None, "abc"), (3, None), (4, " "), (5, None), (5, "a")]
    df = spark.createDataFrame(rows, "id long, selftext string")
    grams = H.char_wb_ngrams("selftext")
    old = df.select("id", F.explode(grams).alias("gram")).groupBy("id").agg(F.count(F.lit(1)), F.count_distinct("gram"))
    got = C.gram_sizes(df, grams)
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("count(1)", "n_grams").replace("count(DISTINCT gram)", "n_distinct") for r in old.collect())
    # only ids that come twice have their grams written out
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_pipeline_report_leaves_no_shuffle_files(spark, monkeypatch):
    from textdims import session

    calls = []
    monkeypatch.setattr(session, "materialize", lambda df, *a, real=session.materialize, **k: (calls.append(k), real(df, *a, **k))[1])
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, t string")
    stages = [("drop_blank", lambda d: C.drop_blank(d, "t")), ("exact_dedup", lambda d: C.exact_dedup(d, "t", ("id",))), ("same", lambda d: d)]
    _, report = C.pipeline_report(df, stages, ("same",))
    assert [(r["stage"], r["rows"]) for r in report.orderBy("step").collect()] == [("read", 4), ("drop_blank", 3), ("exact_dedup", 2), ("same", 2)]
    assert len(calls) == 2 and all(k.get("tidy") and k.get("compression") == "zstd" for k in calls)
