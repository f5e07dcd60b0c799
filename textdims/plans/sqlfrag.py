"""DuckDB SQL fragments mirroring the Spark column expressions.

Generated from the same fixed values as the Spark side so that the oracle
and the plan cannot drift apart.  (DuckDB regexes are RE2: no look-around,
no back-references; ``regexp_replace`` needs the 'g' flag to replace all.)
"""

from __future__ import annotations

from ..functions.text import WORD_PATTERN
from ..sources.tables import folder_sql
from ..operators.tokens import CONTENT_TAG_PREFIXES, SHORT_WORD_TAG, DEFAULT_TAG, STOP_LEMMAS, SUFFIX_RULES, UNKNOWN_LEMMA


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WORD = q(WORD_PATTERN)
STRATUM = folder_sql("lang")


def word_count(col: str) -> str:
    return f"CAST(len(regexp_extract_all({col}, {WORD})) AS BIGINT)"


def tag(w: str) -> str:
    parts = [
        f"WHEN regexp_matches({w}, '^\\p{{N}}+$') THEN 'CD'",
        f"WHEN regexp_matches({w}, '^[.!?]$') THEN 'SENT'",
        f"WHEN regexp_matches({w}, '^[^\\p{{L}}\\p{{N}}_]$') THEN 'PUN'",
        f"WHEN regexp_matches({w}, '^\\p{{Lu}}') AND length({w}) > 1 THEN 'NP'",
    ]
    for t, xs in SUFFIX_RULES:
        rx = "(" + "|".join(xs) + ")$"
        parts.append(f"WHEN regexp_matches(lower({w}), {q(rx)}) THEN '{t}'")
    parts.append(f"WHEN length({w}) <= 3 THEN '{SHORT_WORD_TAG}'")
    return "(CASE " + " ".join(parts) + f" ELSE '{DEFAULT_TAG}' END)"


def lemma(w: str, t: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({w}, '[\\p{{N}}_]') THEN '{UNKNOWN_LEMMA}' "
        f"WHEN {t} = 'NP' THEN {w} ELSE lower({w}) END)"
    )


def resolved_lower(w: str, lm: str) -> str:
    return f"lower(CASE WHEN {lm} IS NULL OR trim({lm}) = '' OR trim({lm}) = '{UNKNOWN_LEMMA}' THEN trim({w}) ELSE trim({lm}) END)"


def content_filter(t: str, lml: str) -> str:
    prefixes = "|".join(CONTENT_TAG_PREFIXES)
    stops = ", ".join(q(s) for s in STOP_LEMMAS)
    return (
        f"regexp_matches({t}, '^({prefixes})') "
        f"AND length(regexp_replace({lml}, '[^\\p{{L}}]', '', 'g')) >= 2 "
        f"AND {lml} NOT IN ({stops})"
    )


def presence_cte(name: str = "presence") -> str:
    """CTE (text_id, stratum, lemma): distinct content lemmas per document."""
    return f"""
_forms AS (
  SELECT doc_id AS text_id, {STRATUM} AS stratum, unnest(regexp_extract_all(text, {WORD})) AS w FROM documents
), _tagged AS (
  SELECT text_id, stratum, w, {tag('w')} AS tg FROM _forms
), _lem AS (
  SELECT text_id, stratum, w, tg, {resolved_lower('w', lemma('w', 'tg'))} AS lml FROM _tagged
), {name} AS (
  SELECT DISTINCT text_id, stratum, lml AS lemma FROM _lem WHERE {content_filter('tg', 'lml')}
)"""


def keyness_cols(a: str, b: str, c: str, d: str, digits: int = 6) -> str:
    A, B, C, D = (f"CAST({x} AS DOUBLE)" for x in (a, b, c, d))
    per_a = f"(CASE WHEN {C} > 0 THEN {A} / {C} * 1000.0 ELSE 0.0 END)"
    per_b = f"(CASE WHEN {D} > 0 THEN {B} / {D} * 1000.0 ELSE 0.0 END)"
    expected = f"(CASE WHEN {C} + {D} > 0 THEN {C} * ({A} + {B}) / ({C} + {D}) ELSE 0.0 END)"
    e1 = f"({C} * ({A} + {B}) / ({C} + {D}))"
    e2 = f"({D} * ({A} + {B}) / ({C} + {D}))"
    ll = f"(CASE WHEN {A} = 0 OR {B} = 0 THEN 0.0 ELSE 2.0 * ({A} * ln({A} / {e1}) + {B} * ln({B} / {e2})) END)"
    diff = f"(CASE WHEN ({per_a} + {per_b}) = 0 THEN 0.0 ELSE 100.0 * ({per_a} - {per_b}) / (({per_a} + {per_b}) / 2.0) END)"
    status = f"(CASE WHEN {ll} >= 3.84 AND {diff} > 0 THEN 'POSKW' WHEN {ll} >= 3.84 THEN 'NEGKW' ELSE 'NOTKW' END)"
    return (
        f"round({per_a}, {digits}) AS target_per_1k, round({per_b}, {digits}) AS comparison_per_1k, "
        f"round({expected}, {digits}) AS expected, round({ll}, {digits}) AS ll, "
        f"round({diff}, {digits}) AS pct_diff, {status} AS status"
    )
