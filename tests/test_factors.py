"""Loading assignment, factor lists, scores, statistics helpers."""

import math

import numpy as np

from textdims.functions import stats
from textdims.operators import factors as FA


def _loadings(spark, rows):
    return spark.createDataFrame([(v, f + 1, x) for v, ls in rows for f, x in enumerate(ls)], "var string, factor int, loading double")


def test_assign_loading_literals(spark):
    rows = [("a", (0.5, 0.2, -0.1)), ("b", (0.2, -0.6, 0.1)), ("c", (0.4, -0.4, 0.1)), ("d", (0.29, 0.1, 0.0))]
    got = {r.var: (r.factor, r.pole) for r in FA.assign_loading(_loadings(spark, rows), 0.3).collect()}
    assert got == {"a": (1, 1), "b": (2, -1)}


def test_factor_lists_literal(spark):
    load = _loadings(spark, [("v1", (0.5, -0.35, 0.1))])
    labels = spark.createDataFrame([("v1", "w")], "var string, lemma string")
    fl = {(r.factor, r.pole): r for r in FA.factor_lists(FA.factor_entries(load, labels, 0.3)).collect()}
    assert fl[(1, 1)].words == "w (.50)"
    assert fl[(2, -1)].words == "(w (-.35))"
    assert fl[(2, -1)].n_primary == 0


def test_factor_scores(spark):
    texts = spark.createDataFrame([(1,), (2,), (3,)], "text_id long")
    hits = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "text_id long, var string")
    prim = spark.createDataFrame([("a", 1, 1), ("b", 1, -1)], "var string, factor int, pole int")
    got = {(r.text_id, r.factor): r.score for r in FA.factor_scores(texts, hits, prim, 2).collect()}
    assert got == {(1, 1): 0, (1, 2): 0, (2, 1): -1, (2, 2): 0, (3, 1): 0, (3, 2): 0}


def test_tetrachoric_median_cut_closed_form():
    for p11 in (0.1, 0.2, 0.3, 0.4):
        n = 100000
        n11 = p11 * n
        n10 = n01 = (0.5 - p11) * n
        n00 = n - n11 - n10 - n01
        r = stats.tetrachoric(np.array([n11]), np.array([n10]), np.array([n01]), np.array([n00]))[0]
        assert abs(r - math.sin(math.pi / 2 * (4 * p11 - 1))) < 1e-6
    assert np.isnan(stats.tetrachoric(np.array([0]), np.array([5]), np.array([5]), np.array([5]))[0])


def test_f_pvalue():
    assert stats.f_sf(949.10, 1, 8550) < 1e-4
    assert abs(stats.f_sf(4.0, 1, 1000000) - 0.0455) < 1e-3


def test_communalities(spark):
    load = _loadings(spark, [("a", (0.5, -0.5)), ("b", (0.9, 0.9)), ("c", (0.1, 0.0))])
    got = {r.var: round(r.communality, 9) for r in FA.communalities(load).collect()}
    assert got == {"a": 0.5, "b": 1.0, "c": 0.01}
    kept, dropped = FA.split_communality(FA.communalities(load))
    assert sorted(r.var for r in kept.collect()) == ["a", "b"] and [r.var for r in dropped.collect()] == ["c"]


def test_secondary_and_tied_loadings(spark):
    load = _loadings(spark, [("v1", (0.5, -0.35, 0.285)), ("v2", (0.4, -0.4, 0.1)), ("v3", (-0.125, -0.605, 0.0))])
    labels = spark.createDataFrame([("v1", "w"), ("v2", "tied"), ("v3", "z")], "var string, lemma string")
    fl = {(r.factor, r.pole): r.words for r in FA.factor_lists(FA.factor_entries(load, labels, 0.3)).collect()}
    assert fl == {(1, 1): "w (.50)", (2, -1): "z (-.60), (w (-.35))"}
