"""Registered matrix / factor / score / group-comparison queries
(J1-J7, J10, B11, B14, B18, B19, C7, C10, D12-D17, D19, D20, E6, E10-E13, H9, H17, H21)."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from ..functions import text as H
from ..operators import factors as FA
from ..operators import groups as G
from ..operators import keyness as K
from ..operators import matrix as M
from ..operators import tokens as T
from ..session import checkpoint_dir, materialize
from ..sources import files as FI
from ..sources import tables
from . import sqlfrag as S
from .q_keyness import _KN_RANKED, CEILING, CUTOFF_PCT, MAX_TOTAL, WEIGHT, WEIGHTED
from .registry import register

R_MIN = 0.3
CUT = FA.CUTOFF
FACTOR_STRATA = ("generic_gpt", "summary_guided_gpt", "generic_qwen")  # strata of the membership loadings
K_FACTORS = 3


# ---------------------------------------------------------------------------
# Spark side: one chain, reused by the queries
# ---------------------------------------------------------------------------
def _texts(spark, sf):
    return tables.texts(spark, sf)


def _index(spark, sf):
    t = _texts(spark, sf)
    kn = K.keyness(T.text_words(t), t, CUTOFF_PCT)
    kw = K.consolidate(K.quota_topk(kn, CEILING, WEIGHTED, WEIGHT), MAX_TOTAL, WEIGHTED)
    # the vocabulary is written once; every later job reads it
    return materialize(M.keyword_index(kw), "keyword-index")


def _hits(spark, sf):
    """Texts, vocabulary, and the narrow hit table, written once: all later steps read it, not the texts."""
    t = _texts(spark, sf)
    idx = _index(spark, sf)
    return t, idx, materialize(M.text_keyword_hits(t, idx), "keyword-hits")


def _matrix_texts(t, hits):
    """B11; the text itself is not needed after the hits are known."""
    return M.drop_zero_rows(t.drop("text"), hits)


def _pairs(spark, sf):
    _, idx, hits = _hits(spark, sf)
    return idx, M.cooccurrence(hits, idx)


def _correlation(hits, idx):
    """J2 of the pairs that some text holds: all others are zero by the method's rule for empty cells."""
    return materialize(M.tetrachoric(M.cooccurrence(hits, idx, absent=False)).filter("flag = 0"), "tetrachoric")


def _components(spark, sf, most=None, always=0):
    _, idx, hits = _hits(spark, sf)
    return idx, FA.principal_components(_correlation(hits, idx), idx, most=most, always=always)


def _rotated(hits, idx):
    """Components, variables of enough communality, their rotated loadings."""
    corr = _correlation(hits, idx)
    comm = FA.communalities(FA.component_loadings(FA.principal_components(corr, idx), idx))
    kept = materialize(idx.join(FA.split_communality(comm)[0].select("var"), "var"), "kept")
    names = kept.select("var")
    among = corr.join(names.withColumnRenamed("var", "var_i"), "var_i").join(names.withColumnRenamed("var", "var_j"), "var_j")
    return materialize(FA.rotate(among, kept, K_FACTORS), "loadings")


def _loaded(spark, sf):
    """Texts, vocabulary, hits and the loading table."""
    t, idx, hits = _hits(spark, sf)
    return t, idx, hits, _rotated(hits, idx)


def _stratum_loadings(spark, sf):
    """Phi of each keyword with membership of a stratum (a profile of the strata, not the dimensions)."""
    t, idx, hits = _hits(spark, sf)
    mt = _matrix_texts(t, hits).select("text_id", "stratum")
    n = mt.select(F.count(F.lit(1))).scalar()
    fmap = F.create_map(*[x for i, s in enumerate(FACTOR_STRATA) for x in (F.lit(s), F.lit(i + 1))])
    ns = mt.groupBy("stratum").agg(F.count(F.lit(1)).alias("ns"))
    nv = hits.groupBy("var").agg(F.count(F.lit(1)).alias("nv"))
    n11 = hits.groupBy("var", "stratum").agg(F.count(F.lit(1)).alias("n11"))
    fac = ns.filter(F.col("stratum").isin(*FACTOR_STRATA)).select("stratum", "ns", fmap[F.col("stratum")].alias("factor"))
    grid = nv.select("var", "nv", F.explode(F.array(*[F.lit(s) for s in FACTOR_STRATA])).alias("stratum")).join(fac, "stratum")
    j = grid.join(n11, ["var", "stratum"], "left").select("var", "factor", "nv", "ns", F.coalesce("n11", F.lit(0)).alias("n11"))
    nd = F.lit(n).cast("double")
    num = nd * F.col("n11") - F.col("nv").cast("double") * F.col("ns")
    den = F.sqrt(F.col("nv").cast("double") * (nd - F.col("nv")) * F.col("ns") * (nd - F.col("ns")))
    return j.select("var", F.col("factor").cast("int").alias("factor"), F.when(den > 0, num / den).otherwise(F.lit(0.0)).alias("loading"))


# ---------------------------------------------------------------------------
# SQL side
# ---------------------------------------------------------------------------
def raw_lemma_sql(w):
    return (
        f"(CASE WHEN regexp_matches({w}, '[\\p{{N}}_]') THEN '<unknown>' "
        f"WHEN regexp_matches({w}, '^\\p{{Lu}}') AND length({w}) > 1 THEN {w} ELSE lower({w}) END)"
    )


_VOCAB = f"""{_KN_RANKED},
ordered AS (
  SELECT lemma, (CASE WHEN stratum = '{WEIGHTED}' THEN 0 WHEN starts_with(stratum, 'summary_guided_') THEN 1
                      WHEN starts_with(stratum, 'generic_') THEN 3 ELSE 2 END) AS p, stratum, rank
  FROM selected ORDER BY p, stratum, rank LIMIT {MAX_TOTAL}),
kw AS (SELECT DISTINCT trim(lemma) AS lemma FROM ordered WHERE trim(lemma) <> ''),
idx AS (SELECT 'v' || lpad(CAST(row_number() OVER (ORDER BY lemma) AS VARCHAR), 6, '0') AS var,
               row_number() OVER (ORDER BY lemma) AS idx, lemma FROM kw),
rl AS (SELECT DISTINCT text_id, stratum, {raw_lemma_sql('w')} AS lemma FROM (
  SELECT doc_id AS text_id, {S.STRATUM} AS stratum, unnest(regexp_extract_all(text, {S.WORD})) AS w FROM documents)),
hits AS (SELECT rl.text_id, rl.stratum, idx.var, idx.idx FROM rl JOIN idx USING (lemma)),
mt AS (SELECT doc_id AS text_id, {S.STRATUM} AS stratum, {S.STRATUM} AS folder FROM documents
       WHERE doc_id IN (SELECT text_id FROM hits)),
nmt AS (SELECT count(*) AS n FROM mt)"""

_PAIRS = f"""{_VOCAB},
marg AS (SELECT i.var, i.idx, CAST(count(h.text_id) AS BIGINT) AS nk FROM idx i LEFT JOIN hits h USING (var) GROUP BY i.var, i.idx),
co AS (SELECT a.var AS var_i, b.var AS var_j, count(*) AS n11 FROM hits a JOIN hits b ON a.text_id = b.text_id AND a.idx < b.idx GROUP BY ALL),
pairs AS (
  SELECT a.var AS var_i, b.var AS var_j, CAST(coalesce(co.n11, 0) AS BIGINT) AS n11,
         CAST(a.nk - coalesce(co.n11, 0) AS BIGINT) AS n10, CAST(b.nk - coalesce(co.n11, 0) AS BIGINT) AS n01,
         CAST((SELECT n FROM nmt) - a.nk - b.nk + coalesce(co.n11, 0) AS BIGINT) AS n00
  FROM marg a JOIN marg b ON a.idx < b.idx LEFT JOIN co ON co.var_i = a.var AND co.var_j = b.var),
phi AS (
  SELECT var_i, var_j,
         CASE WHEN sqrt(CAST(n11 + n10 AS DOUBLE) * (n01 + n00) * (n11 + n01) * (n10 + n00)) > 0
              THEN (CAST(n11 AS DOUBLE) * n00 - CAST(n10 AS DOUBLE) * n01) / sqrt(CAST(n11 + n10 AS DOUBLE) * (n01 + n00) * (n11 + n01) * (n10 + n00))
              ELSE 0.0 END AS r
  FROM pairs)"""

#: Nodes and weights of the quadrature in the oracles.
_NODES, _WEIGHTS = (", ".join(repr(float(x)) for x in v) for v in np.polynomial.legendre.leggauss(40))

#: J2 by bisection of the angle; normal distributions by quadrature.
_TETRACHORIC = f"""{_PAIRS},
gl AS (SELECT [{_NODES}] AS x, [{_WEIGHTS}] AS w),
quantile AS (
  WITH RECURSIVE b AS (
    SELECT DISTINCT nk / CAST((SELECT n FROM nmt) AS DOUBLE) AS p, CAST(-9 AS DOUBLE) AS lo, CAST(9 AS DOUBLE) AS hi, nk, 0 AS step FROM marg
    UNION ALL
    SELECT p, CASE WHEN c < p THEN mid ELSE lo END, CASE WHEN c < p THEN hi ELSE mid END, nk, step + 1
    FROM (SELECT *, 0.5 + mid / 2 / sqrt(2 * pi()) * list_dot_product(w, list_transform(x, lambda u: exp(-(mid * (u + 1) / 2) * (mid * (u + 1) / 2) / 2))) AS c
          FROM (SELECT *, (lo + hi) / 2 AS mid FROM b, gl)) WHERE step < 55)
  SELECT nk, p, (lo + hi) / 2 AS z FROM b WHERE step = 55),
tetra AS MATERIALIZED (
  WITH RECURSIVE b AS (
    SELECT var_i, var_j, h.z AS h, k.z AS k, h.p * k.p - n11 / CAST((SELECT n FROM nmt) AS DOUBLE) AS base, -asin(0.999999) AS lo, asin(0.999999) AS hi, 0 AS step
    FROM pairs JOIN quantile h ON h.nk = n11 + n10 JOIN quantile k ON k.nk = n11 + n01 WHERE n11 > 0 AND n10 > 0 AND n01 > 0 AND n00 > 0
    UNION ALL
    SELECT var_i, var_j, h, k, base, CASE WHEN f > 0 THEN lo ELSE mid END, CASE WHEN f > 0 THEN mid ELSE hi END, step + 1
    FROM (SELECT *, base + mid / 4 / pi() * list_dot_product(w, list_transform(x, lambda u: exp(-(h * h - 2 * h * k * sin(mid * (u + 1) / 2) + k * k) / 2 / pow(cos(mid * (u + 1) / 2), 2)))) AS f
          FROM (SELECT *, (lo + hi) / 2 AS mid FROM b, gl)) WHERE step < 42)
  SELECT pairs.var_i, pairs.var_j, coalesce(sin((lo + hi) / 2), 0.0) AS r, CASE WHEN lo IS NULL THEN 1 ELSE 0 END AS flag
  FROM pairs LEFT JOIN (FROM b WHERE step = 42) b USING (var_i, var_j))"""


def _matrix_sql(variables: str, diagonal: str) -> str:
    """One row: the correlations of ``variables`` (var, idx) as a list of rows, with ``diagonal`` (an expression on var) on its diagonal."""
    return f"""SELECT list(row ORDER BY idx) AS m, list(idx ORDER BY idx) AS idx, list(var ORDER BY idx) AS var FROM (
    SELECT a.idx, a.var, list(CASE WHEN a.idx = b.idx THEN {diagonal} ELSE coalesce(t.r, 0.0) END ORDER BY b.idx) AS row
    FROM {variables} a CROSS JOIN {variables} b LEFT JOIN tetra t ON t.var_i = least(a.var, b.var) AND t.var_j = greatest(a.var, b.var) GROUP BY a.idx, a.var)"""


_PRODUCT = "list_transform({a}, lambda r: list_transform({b}, lambda c: list_dot_product(r, c)))"

#: J3 and B14 by the sign of (R - I): half of 1 + sign projects on the components of at least one.
_COMPONENTS = f"""{_TETRACHORIC},
full_matrix AS MATERIALIZED ({_matrix_sql("idx", "1.0")}),
sign AS (
  WITH RECURSIVE s AS (
    SELECT 0 AS step, list_transform(m, lambda r, i: list_transform(r, lambda x, j: CASE WHEN i = j THEN 0.0 ELSE x / size END)) AS x
    FROM full_matrix, (SELECT list_max(list_transform(m, lambda r: list_sum(list_transform(r, lambda x: abs(x))))) AS size FROM full_matrix)
    UNION ALL
    SELECT step + 1, list_transform(y, lambda r, i: list_transform(y, lambda c, j: (r[j] + c[i]) / 2))
    FROM (SELECT step, list_transform(x, lambda r: list_transform(xx, lambda c, j: 1.5 * r[j] - 0.5 * list_dot_product(r, c))) AS y
          FROM (SELECT step, x, {_PRODUCT.format(a="x", b="x")} AS xx FROM s)) WHERE step < 60)
  SELECT x FROM s WHERE step = 60),
comm AS MATERIALIZED (SELECT unnest(var) AS var, unnest(list_transform(m, lambda r, i: least(1.0, (1.0 + list_dot_product(r, x[i])) / 2))) AS communality FROM full_matrix, sign),
kept AS MATERIALIZED (SELECT idx.* FROM idx JOIN comm USING (var) WHERE communality >= {FA.COMMUNALITY_MIN})"""


def _eigen_sql(name: str, matrix: str, number: int, squarings: int = 26) -> str:
    """CTE ``name`` (found: eigenvalue and vector of the ``number`` largest): squares of the shifted matrix, one vector taken out after each run."""
    return f"""
{name} AS MATERIALIZED (
  WITH RECURSIVE shifted AS (
    SELECT size, list_transform(m, lambda r, i: list_transform(r, lambda x, j: CASE WHEN i = j THEN x + size ELSE x END)) AS m
    FROM {matrix}, (SELECT list_max(list_transform(m, lambda r: list_sum(list_transform(r, lambda x: abs(x))))) AS size FROM {matrix})),
  s AS (
    SELECT 0 AS step, m AS x, CAST([] AS STRUCT(v DOUBLE[], l DOUBLE)[]) AS found FROM shifted
    UNION ALL
    SELECT step + 1,
           CASE WHEN step % {squarings + 1} < {squarings} THEN list_transform(x, lambda r: list_transform(x, lambda c: list_dot_product(r, c) / trace))
                ELSE list_transform(x, lambda r, i: list_transform(r, lambda y, j: m[i][j] - list_sum(list_transform(now, lambda e: e.l * e.v[i] * e.v[j])))) END,
           now
    FROM (SELECT *, CASE WHEN step % {squarings + 1} < {squarings} THEN found
                         ELSE list_append(found, {{'v': v, 'l': list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v)))}}) END AS now
          FROM (SELECT *, list_transform(x[best], lambda y: y / sqrt(x[best][best])) AS v
                FROM (SELECT s.*, m, list_sum(list_transform(x, lambda r: list_dot_product(r, r))) AS trace,
                             list_position(list_transform(x, lambda r, i: r[i]), list_max(list_transform(x, lambda r, i: r[i]))) AS best FROM s, shifted)))
    WHERE step < {number * (squarings + 1)})
  SELECT list_transform(found, lambda e: {{'v': list_transform(e.v, lambda y: y * CASE WHEN list_sum(e.v) < 0 THEN -1.0 ELSE 1.0 END), 'l': e.l - size}}) AS found
  FROM s, shifted WHERE step = {number * (squarings + 1)})"""


_THREE = range(3)


def _sums(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def _inverse(m: str) -> list[list[str]]:
    """The cells of the inverse of a 3 x 3 list of lists, by cofactors."""
    def c(i, j):
        (a, b), (d, e) = ([x % 3 + 1 for x in (k + 1, k + 2)] for k in (i, j))
        return f"({m}[{a}][{d}] * {m}[{b}][{e}] - {m}[{a}][{e}] * {m}[{b}][{d}])"

    det = "(" + " + ".join(f"{m}[1][{j + 1}] * {c(0, j)}" for j in _THREE) + ")"
    return [[f"{c(j, i)} / {det}" for j in _THREE] for i in _THREE]


def _lists(cells) -> str:
    return "[" + ", ".join("[" + ", ".join(row) + "]" for row in cells) + "]"


_COLUMNS_BY = "list_transform({m}, lambda t: list_transform(range(1, len(c[1]) + 1), lambda i: c[1][i] * t[1] + c[2][i] * t[2] + c[3][i] * t[3]))"

#: Three principal factors of the reduced matrix, columns turned plane by plane, then towards their cubes.
_LOAD = f"""{_COMPONENTS},
reduced AS MATERIALIZED ({_matrix_sql("kept", "coalesce((SELECT max(abs(r)) FROM tetra WHERE (var_i = a.var AND var_j IN (SELECT var FROM kept)) OR (var_j = a.var AND var_i IN (SELECT var FROM kept))), 0.0)")}),
{_eigen_sql("eigen", "reduced", 3)},
unrotated AS (SELECT list_transform(found, lambda e: list_transform(e.v, lambda x: x * sqrt(e.l))) AS c FROM eigen),
lengths AS (SELECT c, list_transform(range(1, len(c[1]) + 1), lambda i: sqrt(c[1][i] * c[1][i] + c[2][i] * c[2][i] + c[3][i] * c[3][i])) AS h FROM unrotated),
varimax AS (
  WITH RECURSIVE s AS (
    SELECT 0 AS step, list_transform(c, lambda x: list_transform(x, lambda y, i: CASE WHEN h[i] > 0 THEN y / h[i] ELSE 0.0 END)) AS c, h FROM lengths
    UNION ALL
    SELECT step + 1, list_transform(c, lambda x, f: CASE WHEN f = a THEN list_transform(x, lambda y, i: y * cos(t) + c[b][i] * sin(t))
                                                        WHEN f = b THEN list_transform(x, lambda y, i: y * cos(t) - c[a][i] * sin(t)) ELSE x END), h
    FROM (SELECT *, atan2(2 * {_sums("u", "v")} - 2 * list_sum(u) * list_sum(v) / len(u),
                          {_sums("u", "u")} - {_sums("v", "v")} - (pow(list_sum(u), 2) - pow(list_sum(v), 2)) / len(u)) / 4 AS t
          FROM (SELECT *, list_transform(c[a], lambda y, i: y * y - c[b][i] * c[b][i]) AS u, list_transform(c[a], lambda y, i: 2 * y * c[b][i]) AS v
                FROM (SELECT *, [1, 1, 2][step % 3 + 1] AS a, [2, 3, 3][step % 3 + 1] AS b FROM s)))
    WHERE step < 300)
  SELECT list_transform(c, lambda x: list_transform(x, lambda y, i: y * h[i])) AS c FROM s WHERE step = 300),
target AS (SELECT c, {_lists([[_sums(f"c[{f + 1}]", f"c[{g + 1}]") for g in _THREE] for f in _THREE])} AS x,
                     {_lists([[_sums(f"c[{f + 1}]", f"list_transform(c[{g + 1}], lambda y: y * y * y)") for g in _THREE] for f in _THREE])} AS y FROM varimax),
inverse AS (SELECT c, y, {_lists(_inverse("x"))} AS x FROM target),
turn AS (SELECT c, {_lists([[" + ".join(f"x[{f + 1}][{k + 1}] * y[{k + 1}][{g + 1}]" for k in _THREE) for f in _THREE] for g in _THREE])} AS t FROM inverse),
cross_turn AS (SELECT c, t, {_lists([[_sums(f"t[{f + 1}]", f"t[{g + 1}]") for g in _THREE] for f in _THREE])} AS tt FROM turn),
scaled AS (SELECT c, list_transform(t, lambda x, f: list_transform(x, lambda y: y * sqrt({_lists([[_inverse("tt")[f][f] for f in _THREE]])}[1][f]))) AS t FROM cross_turn),
pattern AS (SELECT unnest({_COLUMNS_BY.format(m="t")}) AS v FROM scaled),
numbered AS (SELECT row_number() OVER (ORDER BY list_dot_product(v, v) DESC) AS factor, list_transform(v, lambda x: x * CASE WHEN list_sum(v) < 0 THEN -1.0 ELSE 1.0 END) AS v FROM pattern),
load AS MATERIALIZED (SELECT unnest(var) AS var, CAST(factor AS INTEGER) AS factor, unnest(v) AS loading FROM numbered, reduced),
mxl AS (SELECT var, max(abs(loading)) AS mx FROM load GROUP BY var),
tops AS (SELECT l.var, l.factor, l.loading FROM load l JOIN mxl m ON l.var = m.var AND abs(l.loading) = m.mx),
prim AS (
  SELECT var, min(factor) AS factor, CASE WHEN min(loading) > 0 THEN 1 ELSE -1 END AS pole, min(loading) AS loading
  FROM tops GROUP BY var HAVING count(*) = 1 AND max(abs(loading)) >= {CUT}),
ent AS (
  SELECT l.factor, CASE WHEN l.loading > 0 THEN 1 ELSE -1 END AS pole, l.var, coalesce(i.lemma, l.var) AS word,
         l.factor = p.factor AS is_primary, l.loading,
         regexp_replace(printf('%.2f', l.loading), '^(-?)0\\.', '\\1.') AS fl, abs(CAST(printf('%.2f', l.loading) AS DOUBLE)) AS sort_key
  FROM load l JOIN prim p ON l.var = p.var LEFT JOIN idx i ON i.var = l.var
  WHERE l.factor = p.factor OR abs(l.loading) >= {CUT}),
ent2 AS (
  SELECT *, CASE WHEN is_primary THEN word || ' (' || fl || ')' ELSE '(' || word || ' (' || fl || '))' END AS entry,
            CASE WHEN is_primary THEN var || ' (' || fl || ')' ELSE '(' || var || ' (' || fl || '))' END AS entry_id
  FROM ent),
sc AS (SELECT h.text_id, p.factor, sum(p.pole) AS score FROM hits h JOIN prim p USING (var) GROUP BY ALL),
fgrid AS (SELECT mt.text_id, f.factor FROM mt CROSS JOIN (SELECT unnest(range(1, {K_FACTORS + 1})) AS factor) f),
scores AS (SELECT g.text_id, CAST(g.factor AS INTEGER) AS factor, CAST(coalesce(sc.score, 0) AS BIGINT) AS score FROM fgrid g LEFT JOIN sc USING (text_id, factor))"""

_FMAP = " ".join(f"WHEN '{s}' THEN {i + 1}" for i, s in enumerate(FACTOR_STRATA))
_STRATA_LIST = ", ".join(f"('{s}')" for s in FACTOR_STRATA)

_STRATUM_LOAD = f"""{_VOCAB},
ns AS (SELECT stratum, count(*) AS ns FROM mt GROUP BY stratum),
nv AS (SELECT var, count(*) AS nv FROM hits GROUP BY var),
n11 AS (SELECT var, stratum, count(*) AS n11 FROM hits GROUP BY var, stratum),
fs AS (SELECT * FROM (VALUES {_STRATA_LIST}) t(stratum)),
lj AS (
  SELECT nv.var, CAST(CASE fs.stratum {_FMAP} END AS INTEGER) AS factor, CAST(nv.nv AS DOUBLE) AS nv, CAST(ns.ns AS DOUBLE) AS ns,
         CAST(coalesce(n11.n11, 0) AS DOUBLE) AS n11, CAST((SELECT n FROM nmt) AS DOUBLE) AS n
  FROM nv CROSS JOIN fs JOIN ns ON ns.stratum = fs.stratum LEFT JOIN n11 ON n11.var = nv.var AND n11.stratum = fs.stratum),
load AS (
  SELECT var, factor, CASE WHEN sqrt(nv * (n - nv) * ns * (n - ns)) > 0 THEN (n * n11 - nv * ns) / sqrt(nv * (n - nv) * ns * (n - ns)) ELSE 0.0 END AS loading
  FROM lj)"""

@register("keyword_index", f"WITH {_VOCAB} SELECT var, CAST(idx AS BIGINT) AS idx, lemma FROM idx")
def q_keyword_index(spark, sf):
    return _index(spark, sf).select("var", F.col("idx").cast("long").alias("idx"), "lemma")


@register("keyword_matrix", f"WITH {_VOCAB} SELECT text_id, var FROM hits")
def q_keyword_matrix(spark, sf):
    return _hits(spark, sf)[2].select("text_id", "var")


@register("drop_zero_rows", f"WITH {_VOCAB} SELECT text_id, stratum FROM mt")
def q_drop_zero_rows(spark, sf):
    t, _, hits = _hits(spark, sf)
    return _matrix_texts(t, hits).select("text_id", "stratum")


@register(
    "presence_grid",
    f"""WITH {_VOCAB}, d AS (SELECT doc_id AS text_id FROM documents)
SELECT d.text_id, i.var, CAST(CASE WHEN h.text_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS present
FROM d CROSS JOIN idx i LEFT JOIN hits h ON h.text_id = d.text_id AND h.var = i.var""",
)
def q_presence_grid(spark, sf):
    t, idx, hits = _hits(spark, sf)
    return M.presence_grid(t, hits, idx)


@register(
    "merge_columns",
    f"""WITH {_VOCAB}
SELECT mt.text_id, CAST((i.idx - 1) // {M.EXPORT_COLUMNS} + 1 AS INTEGER) AS bucket, string_agg(CASE WHEN h.text_id IS NULL THEN '0' ELSE '1' END, '' ORDER BY i.idx) AS flags
FROM mt CROSS JOIN idx i LEFT JOIN hits h ON h.text_id = mt.text_id AND h.idx = i.idx GROUP BY ALL""",
)
def q_merge_columns(spark, sf):
    """The whole 0/1 matrix, one character for each variable."""
    t, idx, hits = _hits(spark, sf)
    return M.merge_columns(_matrix_texts(t, hits), hits, idx)


@register(
    "merge_column_groups",
    f"""WITH {_VOCAB}
SELECT mt.text_id, CAST((i.idx - 1) // {M.EXPORT_COLUMNS} + 1 AS INTEGER) AS "group",
       list(CASE WHEN h.text_id IS NULL THEN 0 ELSE 1 END ORDER BY i.idx) AS flags
FROM mt CROSS JOIN idx i LEFT JOIN hits h ON h.text_id = mt.text_id AND h.idx = i.idx GROUP BY ALL""",
)
def q_merge_column_groups(spark, sf):
    """C10 with an array for each ``EXPORT_COLUMNS`` variables."""
    t, idx, hits = _hits(spark, sf)
    return M.merge_column_groups(_matrix_texts(t, hits), hits, idx)


@register("cooccurrence", f"WITH {_PAIRS} SELECT var_i, var_j, n11, n10, n01, n00 FROM pairs")
def q_cooccurrence(spark, sf):
    return _pairs(spark, sf)[1]


@register("phi_correlation", f"WITH {_PAIRS} SELECT var_i, var_j, round(r, 6) AS r FROM phi")
def q_phi(spark, sf):
    return M.phi(_pairs(spark, sf)[1]).select("var_i", "var_j", F.round("r", 6).alias("r"))


@register(
    "select_by_correlation",
    f"""WITH {_PAIRS}, b AS (SELECT var_i AS var, abs(r) AS ar FROM phi UNION ALL SELECT var_j, abs(r) FROM phi)
SELECT var, round(max(ar), 6) AS max_abs_r FROM b GROUP BY var HAVING max(ar) >= {R_MIN}""",
)
def q_select_by_correlation(spark, sf):
    s = M.select_by_correlation(M.phi(_pairs(spark, sf)[1]), R_MIN)
    return s.select("var", F.round("max_abs_r", 6).alias("max_abs_r"))


@register("tetrachoric", f"WITH {_TETRACHORIC} SELECT var_i, var_j, round(r, 4) AS r, flag FROM tetra")
def q_tetrachoric(spark, sf):
    return M.tetrachoric(_pairs(spark, sf)[1]).select("var_i", "var_j", F.round("r", 4).alias("r"), "flag")


TOP_VARIABLES = 100


@register(
    "select_top_by_correlation",
    f"""WITH {_TETRACHORIC}, b AS (SELECT var_i AS var, abs(r) AS ar FROM tetra UNION ALL SELECT var_j, abs(r) FROM tetra)
SELECT var, round(round(max(ar), 6), 4) AS max_abs_r FROM b GROUP BY var HAVING round(max(ar), 6) >= {R_MIN} ORDER BY round(max(ar), 6) DESC, var LIMIT {TOP_VARIABLES}""",
)
def q_select_top_by_correlation(spark, sf):
    """J10 on the tetrachoric r, the first ``TOP_VARIABLES``; r to six places decides, so that equal ones are ties."""
    _, idx, hits = _hits(spark, sf)
    best = M.select_by_correlation(_correlation(hits, idx).withColumn("r", F.round("r", 6)), R_MIN, TOP_VARIABLES)
    return best.select("var", F.round("max_abs_r", 4).alias("max_abs_r"))


@register("communalities", f"WITH {_COMPONENTS} SELECT var, round(communality, 4) AS communality FROM comm")
def q_communalities(spark, sf):
    idx, found = _components(spark, sf)
    return FA.communalities(FA.component_loadings(found, idx)).select("var", F.round("communality", 4).alias("communality"))


@register(
    "split_communality",
    f"""WITH {_COMPONENTS}
SELECT var, round(communality, 4) AS communality, CASE WHEN communality >= {FA.COMMUNALITY_MIN} THEN 'kept' ELSE 'dropped' END AS "set" FROM comm""",
)
def q_split_communality(spark, sf):
    idx, found = _components(spark, sf)
    kept, dropped = FA.split_communality(FA.communalities(FA.component_loadings(found, idx)))
    both = kept.withColumn("set", F.lit("kept")).unionByName(dropped.withColumn("set", F.lit("dropped")))
    return both.select("var", F.round("communality", 4).alias("communality"), "set")


@register(
    "scree",
    f"""WITH {_TETRACHORIC}, full_matrix AS MATERIALIZED ({_matrix_sql("idx", "1.0")}),{_eigen_sql("eigen", "full_matrix", FA.SCREE)}
SELECT CAST(k AS BIGINT) AS number, round(found[k].l, 4) AS eigenvalue FROM (SELECT found, unnest(range(1, len(found) + 1)) AS k FROM eigen)""",
)
def q_scree(spark, sf):
    found = _components(spark, sf, FA.SCREE, FA.SCREE)[1]
    return FA.scree(FA.eigenvalues(spark, found), FA.SCREE).select("number", F.round("eigenvalue", 4).alias("eigenvalue"))


@register("rotate", f"WITH {_LOAD} SELECT var, factor, round(loading, 4) AS loading FROM load")
def q_rotate(spark, sf):
    return _loaded(spark, sf)[3].select("var", "factor", F.round("loading", 4).alias("loading"))


@register("stratum_loadings", f"WITH {_STRATUM_LOAD} SELECT var, factor, round(loading, 6) AS loading FROM load")
def q_stratum_loadings(spark, sf):
    return _stratum_loadings(spark, sf).select("var", "factor", F.round("loading", 6).alias("loading"))


@register("assign_loading", f"WITH {_LOAD} SELECT var, factor, pole, round(loading, 6) AS loading FROM prim")
def q_assign_loading(spark, sf):
    a = FA.assign_loading(_loaded(spark, sf)[3], CUT)
    return a.select("var", "factor", "pole", F.round("loading", 6).alias("loading"))


@register(
    "loading_table",
    f"""WITH {_LOAD}
SELECT p.factor, p.pole, p.var, coalesce(i.lemma, p.var) AS word, round(p.loading, 6) AS loading,
       coalesce(i.lemma, p.var) || ' (' || p.var || ')' AS label_full,
       row_number() OVER (PARTITION BY p.factor, p.pole ORDER BY p.loading * -p.pole, p.var) AS rank
FROM prim p LEFT JOIN idx i USING (var)""",
)
def q_loading_table(spark, sf):
    _, idx, _, load = _loaded(spark, sf)
    lt = FA.loading_table(load, idx.select("var", "lemma"), CUT)
    return lt.select("factor", "pole", "var", "word", F.round("loading", 6).alias("loading"), "label_full", F.col("rank").cast("long").alias("rank"))


@register(
    "factor_lists",
    f"""WITH {_LOAD}
SELECT factor, pole, count(*) AS n_all, CAST(sum(CASE WHEN is_primary THEN 1 ELSE 0 END) AS INTEGER) AS n_primary,
       string_agg(entry, ', ' ORDER BY -sort_key, word, entry, entry_id) AS words,
       string_agg(entry_id, ', ' ORDER BY -sort_key, word, entry, entry_id) AS var_ids,
       coalesce(string_agg(CASE WHEN is_primary THEN entry END, ', ' ORDER BY -sort_key, word, entry, entry_id), '') AS primary_words
FROM ent2 GROUP BY factor, pole""",
)
def q_factor_lists(spark, sf):
    _, idx, _, load = _loaded(spark, sf)
    fl = FA.factor_lists(FA.factor_entries(load, idx.select("var", "lemma"), CUT))
    return fl.select("factor", "pole", F.col("n_all").cast("long").alias("n_all"), F.col("n_primary").cast("int").alias("n_primary"), "words", "var_ids", "primary_words")


@register(
    "pole_counts",
    f"""WITH {_LOAD}
SELECT factor, pole, count(*) AS n_all, CAST(sum(CASE WHEN is_primary THEN 1 ELSE 0 END) AS BIGINT) AS n_primary FROM ent2 GROUP BY factor, pole""",
)
def q_pole_counts(spark, sf):
    _, idx, _, load = _loaded(spark, sf)
    return FA.pole_counts(FA.factor_entries(load, idx.select("var", "lemma"), CUT))


@register("fmt_loading", f"WITH {_LOAD} SELECT var, factor, fl AS formatted FROM ent")
def q_fmt_loading(spark, sf):
    _, idx, _, load = _loaded(spark, sf)
    e = FA.factor_entries(load, idx.select("var", "lemma"), CUT)
    return e.select("var", "factor", H.fmt_loading(F.regexp_extract("entry", r"\(([-0-9.]+)\)+$", 1).cast("double")).alias("formatted"))


@register("factor_scores", f"WITH {_LOAD} SELECT text_id, factor, score FROM scores")
def q_factor_scores(spark, sf):
    t, idx, hits, load = _loaded(spark, sf)
    prim = FA.assign_loading(load, CUT)
    return FA.factor_scores(_matrix_texts(t, hits), hits, prim, K_FACTORS)


@register(
    "used_words",
    f"""WITH {_LOAD},
uw AS (SELECT h.text_id, p.factor, p.pole, count(*) AS n, string_agg(coalesce(i.lemma, h.var), ', ' ORDER BY coalesce(i.lemma, h.var)) AS words
       FROM hits h JOIN prim p USING (var) LEFT JOIN idx i ON i.var = h.var GROUP BY ALL),
g AS (SELECT mt.text_id, f.factor, pl.pole FROM mt CROSS JOIN (SELECT unnest(range(1, {K_FACTORS + 1})) AS factor) f
      CROSS JOIN (SELECT unnest([1, -1]) AS pole) pl)
SELECT g.text_id, CAST(g.factor AS INTEGER) AS factor, CAST(g.pole AS INTEGER) AS pole, CAST(coalesce(uw.n, 0) AS BIGINT) AS n, coalesce(uw.words, '') AS words
FROM g LEFT JOIN uw USING (text_id, factor, pole)""",
)
def q_used_words(spark, sf):
    t, idx, hits, load = _loaded(spark, sf)
    prim = FA.assign_loading(load, CUT)
    u = FA.used_words(_matrix_texts(t, hits), hits, prim, idx.select("var", "lemma"), K_FACTORS)
    return u.select("text_id", F.col("factor").cast("int").alias("factor"), F.col("pole").cast("int").alias("pole"), F.col("n").cast("long").alias("n"), "words")


_GROUPS_SQL = """(CASE WHEN folder = 'human' THEN 'human' ELSE 'ai' END) AS source,
       (CASE WHEN folder = 'human' THEN 'human' WHEN starts_with(folder, 'generic_') THEN 'generic'
             WHEN starts_with(folder, 'summary_guided_') THEN 'summary_guided' ELSE 'unknown' END) AS prompt,
       (CASE WHEN folder = 'human' THEN 'human' ELSE lower(string_split(folder, '_')[-1]) END) AS model"""


@register(
    "derive_strata",
    f"""WITH d AS (SELECT doc_id AS text_id, {tables.folder_sql('lang')} AS folder FROM documents),
s AS (SELECT text_id, folder, {_GROUPS_SQL} FROM d)
SELECT text_id, folder, source, prompt, model, CASE WHEN source = 'human' THEN 'human' ELSE prompt || '_' || model END AS "group" FROM s""",
)
def q_derive_strata(spark, sf):
    t = _texts(spark, sf)
    s = t.select("text_id", "folder", H.stratum_source("folder").alias("source"), H.stratum_prompt("folder").alias("prompt"), H.stratum_model("folder").alias("model"))
    return s.withColumn("group", H.derive_group("source", "prompt", "model"))


def _scores_grouped(spark, sf):
    t, _, hits, load = _loaded(spark, sf)
    return _grouped(t, hits, load)


def _grouped(t, hits, load):
    prim = FA.assign_loading(load, CUT)
    mt = _matrix_texts(t, hits)
    wide = FA.scores_wide(FA.factor_scores(mt, hits, prim, K_FACTORS), K_FACTORS)
    g = mt.select("text_id", H.stratum_source("folder").alias("source"), H.stratum_model("folder").alias("model"), H.stratum_prompt("folder").alias("prompt"))
    g = g.withColumn("group", H.derive_group("source", "prompt", "model"))
    return g.join(wide, "text_id")


_SCORES_GROUPED = f"""{_LOAD},
sw AS (SELECT text_id, {', '.join(f'max(CASE WHEN factor = {f} THEN score END) AS fac{f}' for f in range(1, K_FACTORS + 1))} FROM scores GROUP BY text_id),
sg AS (SELECT mt.text_id, {_GROUPS_SQL}, {', '.join(f'sw.fac{f}' for f in range(1, K_FACTORS + 1))} FROM mt JOIN sw USING (text_id)),
sgg AS (SELECT *, CASE WHEN source = 'human' THEN 'human' ELSE prompt || '_' || model END AS "group" FROM sg)"""


@register("scores_grouped", f"WITH {_SCORES_GROUPED} SELECT * FROM sgg")
def q_scores_grouped(spark, sf):
    return _scores_grouped(spark, sf)


# --- ANOVA / box statistics on lineitem (value by flag / status) -------------
EFFECTS = ("flag", "status")
DEPENDENTS = ("quantity", "price", "discount")
LI_SQL = """li AS (SELECT l_returnflag AS flag, l_linestatus AS status, l_quantity AS quantity, l_extendedprice AS price,
                         l_discount AS discount, l_orderkey, l_linenumber FROM lineitem)"""


def _anova_sql(src: str, effect: str, dep: str) -> str:
    return f"""SELECT '{effect}' AS effect, '{dep}' AS dependent, CAST(count(*) - 1 AS BIGINT) AS df_model, CAST(sum(n) - count(*) AS BIGINT) AS df_error,
  sum(n * (m - gm) * (m - gm)) AS ss_model, sum(coalesce((n - 1) * v, 0.0)) AS ss_error,
  sum(n) AS n_all, min(gm) AS grand
FROM (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS gm FROM (
      SELECT CAST({effect} AS VARCHAR) AS level, count({dep}) AS n, avg(CAST({dep} AS DOUBLE)) AS m, var_samp(CAST({dep} AS DOUBLE)) AS v
      FROM {src} WHERE {dep} IS NOT NULL AND {effect} IS NOT NULL GROUP BY 1))"""


def _anova_select(digits=6):
    return f"""SELECT effect, dependent, df_model, df_error, round(ss_model, {digits}) AS ss_model, round(ss_error, {digits}) AS ss_error,
  round((ss_model / df_model) / (ss_error / df_error), {digits}) AS f_value, round(ss_model / (ss_model + ss_error), {digits}) AS r_square,
  round(sqrt(ss_error / df_error), {digits}) AS root_mse, round(grand, {digits}) AS dep_mean, round(100.0 * sqrt(ss_error / df_error) / grand, {digits}) AS cv
FROM a"""


def _round_anova(df, digits=6):
    cols = ["ss_model", "ss_error", "f_value", "r_square", "root_mse", "dep_mean", "cv"]
    return df.select("effect", "dependent", "df_model", "df_error", *[F.round(c, digits).alias(c) for c in cols])


def _li(spark, sf):
    return tables.group_scores(spark, sf)


def _anovas(df, effects, deps):
    return G.anova_many(df, effects, deps)


_ANOVA_LI = f"WITH {LI_SQL}, a AS (" + " UNION ALL ".join(_anova_sql("li", e, d) for e in EFFECTS for d in DEPENDENTS) + ") "


@register("anova", _ANOVA_LI + _anova_select())
def q_anova(spark, sf):
    return _round_anova(_anovas(_li(spark, sf), EFFECTS, DEPENDENTS))


@register(
    "fit_statistics",
    _ANOVA_LI + """SELECT effect, dependent, round(ss_model / (ss_model + ss_error), 6) AS r_square,
  round(100.0 * sqrt(ss_error / df_error) / grand, 6) AS cv, round(sqrt(ss_error / df_error), 6) AS root_mse, round(grand, 6) AS dep_mean FROM a""",
)
def q_fit_statistics(spark, sf):
    f = G.fit_statistics(_anovas(_li(spark, sf), EFFECTS, DEPENDENTS))
    return f.select("effect", "dependent", *[F.round(c, 6).alias(c) for c in ("r_square", "cv", "root_mse", "dep_mean")])


@register(
    "group_means",
    f"WITH {LI_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{e}' AS effect, '{d}' AS dependent, CAST({e} AS VARCHAR) AS level, count({d}) AS n, round(avg({d}), 6) AS mean, round(stddev_samp({d}), 6) AS sd "
        f"FROM li WHERE {d} IS NOT NULL AND {e} IS NOT NULL GROUP BY {e}"
        for e in EFFECTS for d in DEPENDENTS
    ),
)
def q_group_means(spark, sf):
    gm = G.group_means(_li(spark, sf), EFFECTS, DEPENDENTS)
    return gm.select("effect", "dependent", "level", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


def _tail_nodes(panels: int = 9):
    """Nodes and weights for the integral of exp(-s) g(s) over s > 0, with panels that grow from 1e-7 to 50."""
    edges = np.r_[0.0, np.geomspace(1e-7, 50.0, 2 * panels)]
    x, w = np.polynomial.legendre.leggauss(24)
    s = np.concatenate([(b - a) / 2 * x + (a + b) / 2 for a, b in zip(edges[:-1], edges[1:], strict=True)])
    w = np.concatenate([(b - a) / 2 * w for a, b in zip(edges[:-1], edges[1:], strict=True)])
    return s, w * np.exp(-s)


_TAIL = tuple(", ".join(repr(float(x)) for x in v) for v in _tail_nodes())

#: p of an F value: the incomplete beta integral with 1 - t = (1 - y) exp(-s / a).
_WITH_P = f""", tail AS (SELECT [{_TAIL[0]}] AS s, [{_TAIL[1]}] AS w),
ap AS (
  SELECT *, exp(h * ln(1 - y) - (lgamma(h) + lgamma(g) - lgamma(h + g))) / h * list_dot_product(w, list_transform(s, lambda u: pow(1 - (1 - y) * exp(-u / h), g - 1))) AS p
  FROM (SELECT *, df_error / 2.0 AS h, df_model / 2.0 AS g, df_model * f / (df_model * f + df_error) AS y
        FROM (SELECT *, (ss_model / df_model) / (ss_error / df_error) AS f FROM a)), tail)
"""
_P_TEXT = "CASE WHEN p < 0.0001 THEN '<.0001' ELSE printf('%.4f', p) END"


@register(
    "anova_table",
    _ANOVA_LI + _WITH_P + f"""SELECT dependent, effect, printf('%.2f', f) AS f, {_P_TEXT} AS p,
  regexp_replace(printf('%.5f', ss_model / (ss_model + ss_error)), '^(-?)0\\.', '\\1.') AS r2,
  printf('%.2f', ss_model / (ss_model + ss_error) * 100.0) AS r2_pct FROM ap""",
)
def q_anova_table(spark, sf):
    return G.anova_table(_anovas(_li(spark, sf), EFFECTS, DEPENDENTS))


@register("anova_pvalue", _ANOVA_LI + _WITH_P + f"SELECT effect, dependent, round(f, 6) AS f_value, round(p, 8) AS p_value, {_P_TEXT} AS p_text FROM ap")
def q_anova_pvalue(spark, sf):
    an = G.with_pvalue(_anovas(_li(spark, sf), EFFECTS, DEPENDENTS))
    return an.select("effect", "dependent", F.round("f_value", 6).alias("f_value"), F.round("p_value", 8).alias("p_value"), G.fmt_p(F.col("p_value")).alias("p_text"))


_SCORE_EFFECTS = ("source", "model", "prompt", "group")
_SCORE_DEPS = tuple(f"fac{f}" for f in range(1, K_FACTORS + 1))


@register(
    "anova_scores",
    f"WITH {_SCORES_GROUPED}, a AS ("
    + " UNION ALL ".join(_anova_sql("sgg", f'"{e}"', d).replace(f"'\"{e}\"' AS effect", f"'{e}' AS effect") for e in _SCORE_EFFECTS for d in _SCORE_DEPS)
    + ") " + _anova_select(),
)
def q_anova_scores(spark, sf):
    sg = materialize(_scores_grouped(spark, sf), "scores-grouped")
    return _round_anova(_anovas(sg, _SCORE_EFFECTS, _SCORE_DEPS))


@register(
    "box_stats",
    f"""WITH {LI_SQL}, g AS (
  SELECT flag AS level, quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.5) AS med, quantile_cont(quantity, 0.75) AS q3,
         min(quantity) AS mn, max(quantity) AS mx, avg(quantity) AS mean, count(quantity) AS n FROM li WHERE quantity IS NOT NULL GROUP BY flag)
SELECT level, round(greatest(mn, q1 - 1.5 * (q3 - q1)), 6) AS low_whisker, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(least(mx, q3 + 1.5 * (q3 - q1)), 6) AS high_whisker, round(mean, 6) AS mean, n FROM g""",
)
def q_box_stats(spark, sf):
    b = G.box_stats(_li(spark, sf), "flag", "quantity")
    return b.select("level", *[F.round(c, 6).alias(c) for c in ("low_whisker", "q1", "median", "q3", "high_whisker", "mean")], "n")


@register(
    "box_outliers",
    f"""WITH {LI_SQL}, v AS (SELECT l_orderkey, l_linenumber, flag, price * price * price * price AS value FROM li), f AS (
  SELECT flag AS level, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v WHERE value IS NOT NULL GROUP BY flag)
SELECT l_orderkey, l_linenumber, level, value FROM v JOIN f ON v.flag = f.level
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def q_box_outliers(spark, sf):
    """Fourth powers of prices: continuous, and skewed enough to have outliers."""
    price = F.col("price")
    return G.box_outliers(_li(spark, sf).withColumn("value", price * price * price * price), "flag", "value", ("l_orderkey", "l_linenumber"))


_RESULTS = {"communalities": ("var", "communality"), "loadings": ("var, factor", "loading"), "scores": ("text_id", ", ".join(_SCORE_DEPS)), "anova": ("effect, dependent", "f_value, r_square")}


@register(
    "results_export",
    f"""WITH {_SCORES_GROUPED}, a AS ("""
    + " UNION ALL ".join(_anova_sql("sgg", f'"{e}"', d).replace(f"'\"{e}\"' AS effect", f"'{e}' AS effect") for e in _SCORE_EFFECTS for d in _SCORE_DEPS)
    + f"""), an AS ({_anova_select(4)})
SELECT 'communalities' AS "table", var AS key, 'communality' AS name, printf('%.4f', communality) AS value FROM comm
UNION ALL SELECT 'loadings', var || ' ' || factor, 'loading', printf('%.4f', loading) FROM load
UNION ALL SELECT 'scores', CAST(text_id AS VARCHAR), 'fac' || factor, printf('%.4f', CAST(score AS DOUBLE)) FROM scores
UNION ALL SELECT 'anova', effect || ' ' || dependent, 'f_value', printf('%.4f', f_value) FROM an
UNION ALL SELECT 'anova', effect || ' ' || dependent, 'r_square', printf('%.4f', r_square) FROM an""",
)
def q_results_export(spark, sf):
    """Communalities, loadings, scores and the effect x factor ANOVA table written in one job, and read back from its files."""
    t, idx, hits = _hits(spark, sf)
    corr = _correlation(hits, idx)
    comm = FA.communalities(FA.component_loadings(FA.principal_components(corr, idx), idx))
    load = _rotated(hits, idx)
    sg = materialize(_grouped(t, hits, load), "scores-grouped")
    tables_ = {
        "communalities": comm,
        "loadings": load,
        "scores": sg.select("text_id", *_SCORE_DEPS),
        "anova": _round_anova(_anovas(sg, _SCORE_EFFECTS, _SCORE_DEPS), 4).select("effect", "dependent", "f_value", "r_square"),
    }
    base = f"{checkpoint_dir(spark).rstrip('/')}/textdims-io/results-{uuid.uuid4().hex}"
    manifest = FI.export_tables(tables_, base)
    out = None
    for name, (keys, values) in _RESULTS.items():
        cols = next(r["columns"] for r in manifest.filter(F.col("name") == name).collect())
        back = spark.read.option("header", "true").option("sep", "\t").csv(f"{base}/{name}").select(*cols)
        pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values.split(", ")])).alias("v")
        rows = back.select(F.lit(name).alias("table"), F.concat_ws(" ", *keys.split(", ")).alias("key"), pairs).select("table", "key", "v.name", F.format_string("%.4f", "v.value").alias("value"))
        out = rows if out is None else out.unionAll(rows)
    return out
