"""Registered keyness queries: documents -> lemma sets -> keyness -> keyword selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WORD_PATTERN
from ..operators import keyness as K
from ..operators import tokens as T
from ..sources import tables
from . import sqlfrag as S
from .registry import register

CUTOFF_PCT = 3.0
CEILING = 250  # keywords of a stratum; the weighted one has WEIGHT times as many
WEIGHTED = "human"
WEIGHT = 2
MAX_TOTAL = 1000

KEYNESS_OUT = (
    "stratum, lemma, target_count, comparison_count, target_per_1k, comparison_per_1k, expected, ll, pct_diff, status"
)


def _presence(spark, sf):
    t = tables.texts(spark, sf)
    return t, T.text_words(t)


def _keyness(spark, sf):
    t, p = _presence(spark, sf)
    return K.keyness(p, t, CUTOFF_PCT)


# keyness with unrounded LL kept for ranking
_KN_RANKED = f"""{S.presence_cte()},
sizes AS (SELECT {S.STRATUM} AS stratum, count(*) AS size FROM documents GROUP BY 1),
tot AS (SELECT sum(size) AS n FROM sizes),
counts AS (SELECT stratum, lemma, count(*) AS a FROM presence GROUP BY stratum, lemma),
gtot AS (SELECT lemma, sum(a) AS g FROM counts GROUP BY lemma),
kr AS (
  SELECT s.stratum, gl.lemma, CAST(coalesce(c.a, 0) AS BIGINT) AS a,
         CAST(gl.g - coalesce(c.a, 0) AS BIGINT) AS b, s.size AS c, CAST(t.n - s.size AS BIGINT) AS d
  FROM gtot gl CROSS JOIN sizes s CROSS JOIN tot t
  LEFT JOIN counts c ON c.lemma = gl.lemma AND c.stratum = s.stratum
  WHERE s.size > 0 AND coalesce(c.a, 0) >= CAST(s.size AS DOUBLE) * {CUTOFF_PCT} / 100.0
),
kn AS (
  SELECT stratum, lemma, a AS target_count, b AS comparison_count, {S.keyness_cols('a', 'b', 'c', 'd', 12)}
  FROM kr
),
shaped AS (
  SELECT *, (CASE status WHEN 'POSKW' THEN 0 WHEN 'NEGKW' THEN 1 ELSE 2 END) AS prio FROM kn
  WHERE status = 'POSKW'
    AND NOT regexp_matches(lemma, '[\\p{{P}}\\p{{Nd}}\\p{{Lu}}\\x{{00B2}}\\x{{00B3}}\\x{{00B9}}\\x{{2070}}-\\x{{2079}}\\x{{2080}}-\\x{{2089}}]')
),
ranked AS (
  SELECT stratum, lemma, row_number() OVER (PARTITION BY stratum ORDER BY prio, round(ll, 2) DESC, lemma) AS rank
  FROM shaped
),
selected AS (
  SELECT * FROM ranked WHERE rank <= CASE WHEN stratum = '{WEIGHTED}' THEN {CEILING * WEIGHT} ELSE {CEILING} END
)"""


@register(
    "doc_frequency",
    f"""WITH {S.presence_cte()}
SELECT stratum, lemma, count(*) AS n_texts FROM presence GROUP BY stratum, lemma""",
)
def q_doc_frequency(spark, sf):
    _, p = _presence(spark, sf)
    return K.doc_frequency(p)


@register(
    "keyness",
    f"""WITH {S.presence_cte()},
sizes AS (SELECT {S.STRATUM} AS stratum, count(*) AS size FROM documents GROUP BY 1),
tot AS (SELECT sum(size) AS n FROM sizes),
counts AS (SELECT stratum, lemma, count(*) AS a FROM presence GROUP BY stratum, lemma),
gtot AS (SELECT lemma, sum(a) AS g FROM counts GROUP BY lemma),
kr AS (
  SELECT s.stratum, gl.lemma, CAST(coalesce(c.a, 0) AS BIGINT) AS a,
         CAST(gl.g - coalesce(c.a, 0) AS BIGINT) AS b, s.size AS c, CAST(t.n - s.size AS BIGINT) AS d
  FROM gtot gl CROSS JOIN sizes s CROSS JOIN tot t
  LEFT JOIN counts c ON c.lemma = gl.lemma AND c.stratum = s.stratum
  WHERE s.size > 0 AND coalesce(c.a, 0) >= CAST(s.size AS DOUBLE) * {CUTOFF_PCT} / 100.0
)
SELECT stratum, lemma, a AS target_count, b AS comparison_count, {S.keyness_cols('a', 'b', 'c', 'd')} FROM kr""",
)
def q_keyness(spark, sf):
    return _keyness(spark, sf).drop("ll_rank_key")


@register(
    "token_keyness",
    f"""WITH _forms AS (
  SELECT {S.STRATUM} AS stratum, unnest(regexp_extract_all(text, {S.WORD})) AS w FROM documents
), toks AS (SELECT stratum, lower(w) AS lemma FROM _forms),
counts AS (SELECT stratum, lemma, count(*) AS a FROM toks GROUP BY stratum, lemma),
sizes AS (SELECT stratum, sum(a) AS size FROM counts GROUP BY stratum),
tot AS (SELECT sum(size) AS n FROM sizes),
gtot AS (SELECT lemma, sum(a) AS g FROM counts GROUP BY lemma),
kr AS (
  SELECT s.stratum, gl.lemma, CAST(coalesce(c.a, 0) AS BIGINT) AS a,
         CAST(gl.g - coalesce(c.a, 0) AS BIGINT) AS b, CAST(s.size AS BIGINT) AS c, CAST(t.n - s.size AS BIGINT) AS d
  FROM gtot gl CROSS JOIN sizes s CROSS JOIN tot t
  LEFT JOIN counts c ON c.lemma = gl.lemma AND c.stratum = s.stratum
)
SELECT stratum, lemma, a AS target_count, b AS comparison_count, {S.keyness_cols('a', 'b', 'c', 'd')} FROM kr""",
)
def q_token_keyness(spark, sf):
    t = tables.texts(spark, sf)
    toks = t.select("stratum", F.explode(F.transform(F.regexp_extract_all("text", F.lit(WORD_PATTERN), 0), lambda w: F.lower(w))).alias("lemma"))
    return K.token_keyness(toks).drop("ll_rank_key")


@register(
    "quota_topk",
    f"""WITH {_KN_RANKED}
SELECT stratum, lemma, CAST(rank AS BIGINT) AS rank FROM selected""",
)
def q_quota_topk(spark, sf):
    return K.quota_topk(_keyness(spark, sf), CEILING, WEIGHTED, WEIGHT).select("stratum", "lemma", F.col("rank").cast("long").alias("rank"))


@register(
    "consolidate",
    f"""WITH {_KN_RANKED},
ordered AS (
  SELECT lemma, (CASE WHEN stratum = '{WEIGHTED}' THEN 0 WHEN starts_with(stratum, 'summary_guided_') THEN 1
                      WHEN starts_with(stratum, 'generic_') THEN 3 ELSE 2 END) AS p, stratum, rank
  FROM selected ORDER BY p, stratum, rank LIMIT {MAX_TOTAL}
)
SELECT DISTINCT lemma FROM ordered""",
)
def q_consolidate(spark, sf):
    sel = K.quota_topk(_keyness(spark, sf), CEILING, WEIGHTED, WEIGHT)
    return K.consolidate(sel, MAX_TOTAL, WEIGHTED)


@register(
    "keyword_shape",
    f"""WITH {_KN_RANKED}
SELECT stratum, lemma FROM shaped""",
)
def q_keyword_shape(spark, sf):
    return K.keyword_shape(_keyness(spark, sf)).select("stratum", "lemma")


@register(
    "rank_keyness",
    f"""WITH {_KN_RANKED.split(',\nshaped AS')[0]}
SELECT stratum, lemma, status, CAST(row_number() OVER (PARTITION BY stratum ORDER BY
  (CASE status WHEN 'POSKW' THEN 0 WHEN 'NEGKW' THEN 1 ELSE 2 END), round(ll, 2) DESC, lemma) AS BIGINT) AS rank FROM kn""",
)
def q_rank_keyness(spark, sf):
    return K.rank_keyness(_keyness(spark, sf)).select("stratum", "lemma", "status", F.col("rank").cast("long").alias("rank"))


@register(
    "keywords_roundtrip",
    f"""WITH {_KN_RANKED},
ordered AS (
  SELECT lemma, (CASE WHEN stratum = '{WEIGHTED}' THEN 0 WHEN starts_with(stratum, 'summary_guided_') THEN 1
                      WHEN starts_with(stratum, 'generic_') THEN 3 ELSE 2 END) AS p, stratum, rank
  FROM selected ORDER BY p, stratum, rank LIMIT {MAX_TOTAL}
)
SELECT DISTINCT trim(lemma) AS lemma FROM ordered WHERE trim(lemma) <> ''""",
)
def q_keywords_roundtrip(spark, sf):
    import uuid

    from ..session import checkpoint_dir
    from ..sources import files as FI

    path = f"{checkpoint_dir(spark).rstrip('/')}/textdims-io/keywords-{uuid.uuid4().hex}"
    sel = K.quota_topk(_keyness(spark, sf), CEILING, WEIGHTED, WEIGHT)
    FI.write_keywords(K.consolidate(sel, MAX_TOTAL, WEIGHTED), path)
    return FI.read_keywords(spark, path)
