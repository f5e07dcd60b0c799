"""Eigenpairs from a long correlation table, components, rotation."""

import numpy as np
import pytest

from textdims.operators import factors as FA
from textdims.operators import spectral as S


def corr_table(spark, r):
    p = len(r)
    rows = [(f"v{i:03d}", f"v{j:03d}", float(r[i, j])) for i in range(p) for j in range(i + 1, p) if r[i, j]]
    index = spark.createDataFrame([(f"v{i:03d}", i + 1) for i in range(p)], "var string, idx int")
    return spark.createDataFrame(rows, "var_i string, var_j string, r double"), index


def some_corr(p, rank, seed=0, noise=0.5):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(p, rank))
    r = a @ a.T + np.diag(rng.random(p) * noise * rank + 0.1)
    d = np.sqrt(np.diag(r))
    return r / d[:, None] / d


def dense(found, p, k):
    out = np.zeros((p, k))
    for r in found.combine(np.eye(k)).collect():
        out[r["idx"] - 1, r["factor"] - 1] = r["value"]
    return out


@pytest.mark.parametrize("p,block,tile", [(23, 4, 5), (40, 64, 16), (1, 8, 4)])
def test_leading_eigenpairs(spark, p, block, tile):
    r = some_corr(p, 6)
    corr, index = corr_table(spark, r)
    ones = S.diagonal(index.selectExpr("idx", "1.0 as value"), tile)
    found = S.leading_eigenpairs(S.tiles(corr, index, tile), ones, 5, block=block)
    want, v = np.linalg.eigh(r)
    k = min(5, p)
    assert np.allclose(found.values, want[::-1][:k], atol=1e-9)
    got = dense(found, p, k)
    assert np.allclose(np.abs(got.T @ v[:, ::-1][:, :k]), np.eye(k), atol=1e-7) and (got.sum(axis=0) > -1e-9).all()


def test_converges_before_the_panels_span_everything(spark):
    """A few large eigenvalues of many variables: found with far fewer columns than variables."""
    r = some_corr(300, 3, noise=0.2)
    corr, index = corr_table(spark, r)
    found = S.leading_eigenpairs(S.tiles(corr, index, 64), S.diagonal(index.selectExpr("idx", "1.0 as value"), 64), 3, block=8)
    assert np.allclose(found.values, np.linalg.eigvalsh(r)[::-1][:3], atol=1e-8)
    assert found._mix.shape[0] < 200


def test_repeated_eigenvalues_need_fresh_panels(spark):
    corr, index = corr_table(spark, np.eye(12))
    found = S.leading_eigenpairs(S.tiles(corr, index, 8), S.diagonal(index.selectExpr("idx", "1.0 as value"), 8), 100, 1.0, block=5)
    assert np.allclose(found.values, np.ones(12))


def test_all_eigenvalues_add_up_to_the_trace_and_components(spark):
    r = some_corr(30, 4, seed=2)
    corr, index = corr_table(spark, r)
    found = FA.principal_components(corr, index, always=30)
    assert abs(found.values.sum() - 30) < 1e-8
    values, v = np.linalg.eigh(r)
    want = np.minimum(1, ((v**2) * values)[:, values >= 1].sum(axis=1))
    got = {r_["var"]: r_["communality"] for r_ in FA.communalities(FA.component_loadings(found, index)).collect()}
    assert np.allclose([got[f"v{i:03d}"] for i in range(30)], want, atol=1e-8)
    scree = FA.scree(FA.eigenvalues(spark, found), 20).collect()
    assert [r_["number"] for r_ in scree] == list(range(1, 21)) and np.allclose([r_["eigenvalue"] for r_ in scree], values[::-1][:20])


def test_no_component_is_left_out(spark):
    """105 pairs of variables: as many components, more than a hundred."""
    pairs = [(f"v{2 * k:03d}", f"v{2 * k + 1:03d}", 0.3 + k / 200) for k in range(105)]
    index = spark.createDataFrame([(f"v{k:03d}", k + 1) for k in range(210)], "var string, idx int")
    found = FA.principal_components(spark.createDataFrame(pairs, "var_i string, var_j string, r double"), index)
    assert np.allclose(found.values, [1 + r for _, _, r in pairs[::-1]])
    got = {x["var"]: x["communality"] for x in FA.communalities(FA.component_loadings(found, index)).collect()}
    assert len(got) == 210 and all(abs(got[v] - (1 + r) / 2) < 1e-8 for a, b, r in pairs for v in (a, b))
    assert len(FA.principal_components(spark.createDataFrame(pairs, "var_i string, var_j string, r double"), index, most=7).values) == 7


def test_value_that_comes_more_often_than_a_panel_has_columns(spark):
    r = np.eye(60)
    r[:20, :20] = some_corr(20, 2, noise=0.2)
    corr, index = corr_table(spark, r)
    found = S.leading_eigenpairs(S.tiles(corr, index, 16), S.diagonal(index.selectExpr("idx", "1.0 as value"), 16), 100, 1.0, block=6)
    want = np.linalg.eigvalsh(r)[::-1]
    assert np.allclose(found.values, want[want >= 1 - 1e-9]) and (np.abs(found.values - 1) < 1e-9).sum() == 40


def by_sums_of_angles(a):
    """Varimax by turning the columns themselves."""
    p, k = a.shape
    a = a.copy()
    for _ in range(200):
        for f in range(k):
            for g in range(f + 1, k):
                u, v = a[:, f] ** 2 - a[:, g] ** 2, 2 * a[:, f] * a[:, g]
                up, side = 2 * (u @ v) - 2 * u.sum() * v.sum() / p, u @ u - v @ v - (u.sum() ** 2 - v.sum() ** 2) / p
                t = np.arctan2(up, side) / 4
                a[:, [f, g]] = a[:, [f, g]] @ np.array([[np.cos(t), -np.sin(t)], [np.sin(t), np.cos(t)]])
    return a


def test_rotation_against_columns(spark):
    """Principal factors of the reduced matrix, varimax at unit rows and promax, worked off on dense columns."""
    r = some_corr(25, 3, seed=5)
    corr, index = corr_table(spark, r)
    off = np.abs(r - np.eye(25))
    values, v = np.linalg.eigh(r - np.eye(25) + np.diag(off.max(axis=1)))
    a = v[:, ::-1][:, :3] * np.sqrt(values[::-1][:3])
    a = a * np.where(a.sum(axis=0) < 0, -1, 1)
    h = np.linalg.norm(a, axis=1, keepdims=True)
    straight = by_sums_of_angles(a / h) * h
    turn = np.linalg.lstsq(straight, straight**3, rcond=None)[0]
    turn = turn * np.sqrt(np.diag(np.linalg.inv(turn.T @ turn)))
    want = straight @ turn
    want = want[:, np.argsort(-(want**2).sum(axis=0))]
    want = want * np.where(want.sum(axis=0) < 0, -1, 1)
    got = np.zeros((25, 3))
    for x in FA.rotate(corr, index, 3).collect():
        got[int(x["var"][1:]), x["factor"] - 1] = x["loading"]
    assert np.allclose(got, want, atol=1e-7)
    # the pattern and the correlations of its factors give back the principal factors' matrix
    phi = np.linalg.inv(np.linalg.lstsq(got, a, rcond=None)[0] @ np.linalg.lstsq(got, a, rcond=None)[0].T)
    assert np.allclose(np.diag(np.linalg.inv(phi)), 1, atol=1e-6)


def test_simple_structure_is_found(spark):
    """Three groups of variables that only correlate within: each loads on a factor of its own."""
    p = 24
    r = np.array([[1.0 if i == j else 0.6 + 0.01 * ((i + j) % 3) if i % 3 == j % 3 else 0.02 for j in range(p)] for i in range(p)])
    corr, index = corr_table(spark, r)
    best = FA.assign_loading(FA.rotate(corr, index, 3), 0.3).collect()
    assert len(best) == p and len({x["factor"] for x in best}) == 3
    for x in range(3):
        assert len({b["factor"] for b in best if int(b["var"][1:]) % 3 == x}) == 1


def test_nothing_to_factor(spark):
    corr, index = corr_table(spark, np.eye(3))
    assert FA.rotate(corr, index, 3).count() == 0
    assert FA.rotate(corr, index.limit(0), 3).count() == 0
    assert len(FA.principal_components(corr, index.limit(0)).values) == 0
