"""Registered queries: examples, prompts, tagging, language id, corpus size, completion job
(E5, E9, J8, J9, H6-H8, H10-H14, H21, C1-C5, C9, C12, C13, P1-P4, D9, B12, B20, A17)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as H
from ..operators import clean as CL
from ..operators import corpus as CO
from ..operators import examples as EX
from ..operators import factors as FA
from ..operators import lang as LG
from ..operators import prompts as PR
from ..operators import tokens as T
from ..session import checkpoint_dir, materialize
from ..sources import tables
from . import sqlfrag as S
from .q_clean import _FENCES, POSTS_SQL, preview_sql
from .q_dims import _GROUPS_SQL, _LOAD, CUT, K_FACTORS, _loaded, _matrix_texts
from .registry import register

N_TOP, N_OTHER = EX.N_TOP, EX.N_OTHER


def _examples_inputs(spark, sf):
    t, idx, hits, load = _loaded(spark, sf)
    prim = FA.assign_loading(load, CUT)
    mt = _matrix_texts(t, hits)
    scores = materialize(FA.factor_scores(mt, hits, prim, K_FACTORS), "factor-scores")
    groups = mt.select("text_id", H.derive_group(H.stratum_source("folder"), H.stratum_prompt("folder"), H.stratum_model("folder")).alias("group"))
    return t, idx, hits, load, prim, scores, groups


_EX_SQL = f"""{_LOAD},
grp AS (SELECT text_id, CASE WHEN source = 'human' THEN 'human' ELSE prompt || '_' || model END AS grp
        FROM (SELECT text_id, folder, {_GROUPS_SQL} FROM mt)),
poles AS (SELECT unnest([1, -1]) AS pole),
gm AS (SELECT s.factor, g.grp, avg(s.score) AS mean FROM scores s JOIN grp g USING (text_id) GROUP BY ALL),
gp AS (SELECT gm.*, poles.pole, row_number() OVER (PARTITION BY gm.factor, poles.pole ORDER BY gm.mean * -poles.pole, gm.grp) AS group_rank
       FROM gm CROSS JOIN poles),
sr AS (SELECT s.text_id, s.factor, g.grp, s.score, poles.pole,
              row_number() OVER (PARTITION BY s.factor, poles.pole, g.grp ORDER BY s.score * -poles.pole, s.text_id) AS rn
       FROM scores s JOIN grp g USING (text_id) CROSS JOIN poles WHERE s.score <> 0),
ej AS (SELECT sr.*, gp.group_rank, gp.mean FROM sr JOIN gp ON gp.factor = sr.factor AND gp.pole = sr.pole AND gp.grp = sr.grp
       WHERE sr.rn <= CASE WHEN gp.group_rank = 1 THEN {N_TOP} ELSE {N_OTHER} END),
ex AS (SELECT CAST(factor AS INTEGER) AS factor, CAST(pole AS INTEGER) AS pole,
              CAST(row_number() OVER (PARTITION BY factor, pole ORDER BY group_rank, rn) AS INTEGER) AS ex_id,
              grp, CAST(group_rank AS INTEGER) AS group_rank, CAST(rn AS INTEGER) AS rn, text_id, score, mean FROM ej)"""


@register(
    "top_examples",
    f"""WITH {_EX_SQL}
SELECT factor, pole, ex_id, grp AS "group", group_rank, rn, text_id, score, round(mean, 6) AS mean FROM ex""",
)
def q_top_examples(spark, sf):
    *_, scores, groups = _examples_inputs(spark, sf)
    e = EX.top_examples(scores, groups)
    return e.select(
        F.col("factor").cast("int").alias("factor"), F.col("pole").cast("int").alias("pole"), F.col("ex_id").cast("int").alias("ex_id"),
        "group", F.col("group_rank").cast("int").alias("group_rank"), F.col("rn").cast("int").alias("rn"), "text_id", "score",
        F.round("mean", 6).alias("mean"),
    )


@register(
    "example_labels",
    f"""WITH {_EX_SQL}
SELECT text_id, printf('f%d_%s_%03d', factor, CASE WHEN pole = 1 THEN 'pos' ELSE 'neg' END, ex_id) AS label FROM ex""",
)
def q_example_labels(spark, sf):
    *_, scores, groups = _examples_inputs(spark, sf)
    e = EX.top_examples(scores, groups)
    return e.select("text_id", EX.example_label(F.col("factor"), F.col("pole"), F.col("ex_id")).alias("label"))


def _pole_lemmas(load, idx):
    """Lemmas listed for a pole, primary and secondary ones."""
    return FA.factor_entries(load, idx.select("var", "lemma"), CUT).select("factor", "pole", F.col("word").alias("lemma"))


_STOP = ", ".join(S.q(x) for x in EX.HIGHLIGHT_STOPLIST)
_ANN_SQL = f"""{_EX_SQL},
apl AS (SELECT DISTINCT factor, pole, word AS lemma FROM ent WHERE word NOT IN ({_STOP})),
aet AS (SELECT ex.factor, ex.pole, ex.ex_id, ex.text_id, regexp_extract_all(regexp_replace(d.text, '[{{}}\\\\]', '', 'g'), {S.q(T.TOKEN_PATTERN)}) AS ws
        FROM ex JOIN documents d ON d.doc_id = ex.text_id),
atk AS (SELECT factor, pole, ex_id, text_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM aet),
amk AS (SELECT atk.*, apl.lemma AS hit, CASE WHEN apl.lemma IS NULL THEN word ELSE '\\textbf{{' || word || '}}' END AS m
        FROM atk LEFT JOIN apl ON apl.factor = atk.factor AND apl.pole = atk.pole AND apl.lemma = {S.lemma('atk.word', S.tag('atk.word'))}),
ajn AS (SELECT factor, pole, ex_id, text_id, string_agg(m, ' ' ORDER BY pos) AS t,
               coalesce(array_to_string(list_sort(list_distinct(list(hit) FILTER (hit IS NOT NULL))), ', '), '') AS matched_lemmas FROM amk GROUP BY ALL),
arj AS (SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
  '\\b([A-Za-z]+)\\s+n[''’]t\\b', '\\1n''t', 'g'), '\\s+([,.!?])', '\\1', 'g'), '\\s+"', '"', 'g'), '"\\s+', '"', 'g') AS t) FROM ajn),
aes AS (SELECT * REPLACE (replace(replace(replace(replace(t, '$', '\\$'), '#', '\\#'), '&', '\\&'), '_', '\\_') AS t) FROM arj),
ann AS (SELECT factor, pole, ex_id, text_id, array_to_string(list_transform(list_filter(list_transform(string_split(
    regexp_replace(t, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''),
    lambda x: regexp_replace(x, '(\\p{{So}})', '{{\\\\EmojiFont \\1}}', 'g')), chr(10)) AS paragraphs, matched_lemmas FROM aes)"""


@register("examples", f"WITH {_ANN_SQL} SELECT factor, pole, ex_id, text_id, paragraphs, matched_lemmas FROM ann")
def q_examples(spark, sf):
    t, idx, hits, load, prim, scores, groups = _examples_inputs(spark, sf)
    e = EX.top_examples(scores, groups)
    a = EX.annotate_examples(e, t, _pole_lemmas(load, idx))
    return a.select(*[F.col(c).cast("int").alias(c) for c in ("factor", "pole", "ex_id")], "text_id", "paragraphs", "matched_lemmas")


BUNDLE_SYSTEM = "You are an expert in register analysis interpreting dimensions of variation."
BUNDLE_TASK = "Interpret dimension %s, %s pole, from the loadings, the group means and the excerpts below."


@register(
    "plain_examples",
    f"""WITH {_EX_SQL},
puw AS (SELECT h.text_id, p.factor, p.pole, count(*) AS n, string_agg(coalesce(i.lemma, h.var), ', ' ORDER BY coalesce(i.lemma, h.var)) AS words
       FROM hits h JOIN prim p USING (var) LEFT JOIN idx i ON i.var = h.var GROUP BY ALL),
pd AS (SELECT ex.factor, ex.pole, ex.ex_id, ex.text_id, ex.score, ex.grp, m.folder, d.text, coalesce(u.n, 0) AS n, coalesce(u.words, '') AS words,
              'f' || ex.factor || '_' || (CASE WHEN ex.pole = 1 THEN 'pos' ELSE 'neg' END) AS label
       FROM ex JOIN documents d ON d.doc_id = ex.text_id JOIN mt m ON m.text_id = ex.text_id
       LEFT JOIN puw u ON u.text_id = ex.text_id AND u.factor = ex.factor AND u.pole = ex.pole)
SELECT factor, pole, ex_id, text_id, 'Text ID: ' || text_id || chr(10) || 'Group: ' || grp || chr(10) || 'Model: ' ||
       (CASE WHEN folder = 'human' THEN 'human' ELSE lower(string_split(folder, '_')[-1]) END) || chr(10) || 'File:   ' || folder || '/' || text_id || chr(10) || chr(10) ||
       'Score (' || label || '): ' || score || chr(10) || 'Loading words (' || label || '), N=' || n || ': ' || words || chr(10) || text AS document
FROM pd""",
)
def q_plain_examples(spark, sf):
    t, idx, hits, load, prim, scores, groups = _examples_inputs(spark, sf)
    e = EX.top_examples(scores, groups)
    used = FA.used_words(_matrix_texts(t, hits), hits, prim, idx.select("var", "lemma"), K_FACTORS)
    shown = t.join(groups, "text_id").select(
        "text_id", "group", H.stratum_model("folder").alias("model"), F.concat_ws("/", "folder", F.col("text_id").cast("string")).alias("file"), "text"
    )
    docs, _ = EX.plain_examples(e, shown, used)
    return docs.select(*[F.col(c).cast("int").alias(c) for c in ("factor", "pole", "ex_id")], "text_id", "document")


@register(
    "interpretation_bundle",
    f"""WITH {_ANN_SQL},
buw AS (SELECT h.text_id, p.factor, p.pole, string_agg(coalesce(i.lemma, h.var), ', ' ORDER BY coalesce(i.lemma, h.var)) AS words
       FROM hits h JOIN prim p USING (var) LEFT JOIN idx i ON i.var = h.var GROUP BY ALL),
bb AS (SELECT a.factor, a.pole, a.ex_id, CASE WHEN a.pole = 1 THEN 'pos' ELSE 'neg' END AS pn, a.text_id,
              array_to_string(string_split(a.paragraphs, chr(10))[1:{EX.BUNDLE_LINES}], chr(10)) AS body, coalesce(nullif(u.words, ''), '(none)') AS words
       FROM ann a LEFT JOIN buw u ON u.text_id = a.text_id AND u.factor = a.factor AND u.pole = a.pole WHERE a.ex_id <= {EX.BUNDLE_EXAMPLES}),
bk AS (SELECT factor, pole, pn, string_agg(chr(10) || '===== EXCERPT: ' || printf('f%d_%s_%03d', factor, pn, ex_id) || ' (text ID ' || text_id || ') =====' || chr(10) || body ||
              chr(10) || chr(10) || '--- Loading words for this example (' || pn || '): ' || words || chr(10), chr(10) ORDER BY ex_id) AS blocks FROM bb GROUP BY ALL),
bl AS (SELECT factor, pole, 'variables loading on this pole = ' || count(*) || chr(10) || string_agg(entry, ', ' ORDER BY -sort_key, word, entry, entry_id) AS loadings FROM ent2 GROUP BY factor, pole),
bm AS (SELECT factor, array_to_string(list_sort(list(grp || chr(9) || n || chr(9) || printf('%.4f', mean))), chr(10)) AS means
       FROM (SELECT s.factor, g.grp, count(*) AS n, avg(s.score) AS mean FROM scores s JOIN grp g USING (text_id) GROUP BY ALL) GROUP BY factor)
SELECT bk.factor, bk.pole, {S.q(BUNDLE_SYSTEM)} || chr(10) || chr(10) || 'Interpret dimension f' || bk.factor || ', ' || pn ||
       ' pole, from the loadings, the group means and the excerpts below.' || chr(10) || chr(10) || '=== MEAN SOURCE SCORES ===' || chr(10) || coalesce(means, '') || chr(10) ||
       chr(10) || '=== FACTOR LOADINGS (f' || bk.factor || '_' || pn || ') ===' || chr(10) || coalesce(loadings, '') || chr(10) || chr(10) || '=== EXAMPLE EXCERPTS ===' || chr(10) || blocks AS prompt
FROM bk LEFT JOIN bl ON bl.factor = bk.factor AND bl.pole = bk.pole LEFT JOIN bm ON bm.factor = bk.factor""",
)
def q_interpretation_bundle(spark, sf):
    t, idx, hits, load, prim, scores, groups = _examples_inputs(spark, sf)
    e = EX.top_examples(scores, groups)
    ann = EX.annotate_examples(e, t, _pole_lemmas(load, idx))
    used = FA.used_words(_matrix_texts(t, hits), hits, prim, idx.select("var", "lemma"), K_FACTORS)
    exc = ann.join(used, ["text_id", "factor", "pole"], "left").select(
        "factor", "pole", "ex_id", "text_id", F.col("paragraphs").alias("body"), F.coalesce("words", F.lit("")).alias("loading_words")
    )
    fl = FA.factor_lists(FA.factor_entries(load, idx.select("var", "lemma"), CUT))
    lt = fl.select("factor", "pole", F.concat(F.format_string("variables loading on this pole = %d\n", F.col("n_all")), F.col("words")).alias("loadings"))
    means = EX.group_means(scores, groups).groupBy("factor").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", "group", F.col("n").cast("string"), H.printed("mean", 4)))), "\n").alias("means")
    )
    b = EX.interpretation_bundle(e, exc, lt, means, BUNDLE_SYSTEM, BUNDLE_TASK)
    return b.select(F.col("factor").cast("int").alias("factor"), F.col("pole").cast("int").alias("pole"), "prompt")


# --- tagging / tokens ---------------------------------------------------------
_TOK_SQL = f"""toks AS (
  SELECT doc_id AS text_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos, unnest(arr) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, {S.q(T.TOKEN_PATTERN)}) AS arr FROM documents)),
tagged AS (SELECT text_id, pos, word, {S.tag('word')} AS tag FROM toks),
tl AS (SELECT text_id, pos, word, tag, {S.lemma('word', 'tag')} AS lemma FROM tagged)"""


@register("tag_tokens", f"WITH {_TOK_SQL} SELECT text_id, pos, word, tag, lemma FROM tl")
def q_tag_tokens(spark, sf):
    return T.tag_tokens(tables.texts(spark, sf)).select("text_id", F.col("pos").cast("int").alias("pos"), "word", "tag", "lemma")


@register(
    "content_tokens",
    f"""WITH {_TOK_SQL}, r AS (SELECT text_id, pos, tag, {S.resolved_lower('word', 'lemma')} AS lemma_lc FROM tl)
SELECT text_id, pos, lemma_lc FROM r WHERE {S.content_filter('tag', 'lemma_lc')}""",
)
def q_content_tokens(spark, sf):
    c = T.content_tokens(T.tag_tokens(tables.texts(spark, sf)))
    return c.select("text_id", F.col("pos").cast("int").alias("pos"), "lemma_lc")


# --- text rendering helpers (H10-H14) -----------------------------------------
@register(
    "detokenize",
    f"""WITH {_TOK_SQL}, j AS (SELECT text_id, string_agg(word, ' ' ORDER BY pos) AS t FROM toks GROUP BY text_id)
SELECT text_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
  '\\b([A-Za-z]+)\\s+n[''’]t\\b', '\\1n''t', 'g'), '\\s+([,.!?])', '\\1', 'g'), '\\s+"', '"', 'g'), '"\\s+', '"', 'g') AS text FROM j""",
)
def q_detokenize(spark, sf):
    # the texts are dealt by their ids, so that no token is
    tk = T.tag_tokens(tables.texts(spark, sf).repartition("text_id"))
    g = tk.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("ws"))
    return g.select("text_id", H.detokenize(F.transform("ws", lambda s: s["word"])).alias("text"))


@register(
    "split_sentences",
    """WITH s AS (SELECT doc_id AS text_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)),
       lambda x: trim(x)), lambda x: x <> '') AS xs FROM documents)
SELECT text_id, CAST(generate_subscripts(xs, 1) - 1 AS INTEGER) AS n, unnest(xs) AS sentence FROM s""",
)
def q_split_sentences(spark, sf):
    t = tables.texts(spark, sf)
    return t.select("text_id", F.posexplode(H.split_sentences(F.col("text"))).alias("n", "sentence"))


@register(
    "escape_map",
    """SELECT doc_id AS text_id, replace(replace(replace(replace(replace(replace(replace(text, '{', ''), '}', ''), '\\', ''),
  '$', '\\$'), '#', '\\#'), '&', '\\&'), '_', '\\_') AS escaped FROM documents""",
)
def q_escape_map(spark, sf):
    return tables.texts(spark, sf).select("text_id", H.escape_map(F.col("text")).alias("escaped"))


@register("wrap_symbols", "SELECT doc_id AS text_id, regexp_replace(text, '(\\p{So})', '{\\\\EmojiFont \\1}', 'g') AS wrapped FROM documents")
def q_wrap_symbols(spark, sf):
    return tables.texts(spark, sf).select("text_id", H.wrap_symbols(F.col("text")).alias("wrapped"))


@register(
    "highlight",
    f"""WITH {_EX_SQL},
pl AS (SELECT DISTINCT factor, pole, word AS lemma FROM ent
       WHERE word NOT IN ({', '.join(S.q(s) for s in EX.HIGHLIGHT_STOPLIST)})),
et AS (SELECT ex.factor, ex.pole, ex.ex_id, ex.text_id, d.text FROM ex JOIN documents d ON d.doc_id = ex.text_id),
w AS (SELECT factor, pole, ex_id, text_id, unnest(regexp_extract_all(regexp_replace(text, '[{{}}\\\\]', '', 'g'), {S.q(T.TOKEN_PATTERN)})) AS word FROM et),
m AS (SELECT DISTINCT w.factor, w.pole, w.ex_id, w.text_id, {S.lemma('w.word', S.tag('w.word'))} AS lemma FROM w
      JOIN pl ON pl.factor = w.factor AND pl.pole = w.pole AND pl.lemma = {S.lemma('w.word', S.tag('w.word'))})
SELECT factor, pole, ex_id, text_id, string_agg(lemma, ', ' ORDER BY lemma) AS matched_lemmas FROM m GROUP BY ALL""",
)
def q_highlight(spark, sf):
    t, idx, hits, load, prim, scores, groups = _examples_inputs(spark, sf)
    ann = EX.annotate_examples(EX.top_examples(scores, groups), t, _pole_lemmas(load, idx))
    return ann.filter(F.col("matched_lemmas") != "").select(
        F.col("factor").cast("int").alias("factor"), F.col("pole").cast("int").alias("pole"), F.col("ex_id").cast("int").alias("ex_id"),
        "text_id", "matched_lemmas",
    )


@register(
    "head_lines",
    "SELECT doc_id AS text_id, array_to_string(string_split(text, chr(10))[1:30], chr(10)) AS excerpt FROM documents",
)
def q_head_lines(spark, sf):
    return tables.texts(spark, sf).select("text_id", EX.head_lines(F.col("text"), 30).alias("excerpt"))


# --- prompts (H6-H8, C1-C5) -------------------------------------------------------
_LEN_SQL = """(CASE WHEN wc IS NULL THEN '- Length: 120–500 words.' || chr(10)
  ELSE '- Length: ' || CAST(greatest(10, CAST(round(greatest(1, wc) * 0.8) AS BIGINT)) AS VARCHAR) || '–' ||
       CAST(greatest(greatest(10, CAST(round(greatest(1, wc) * 0.8) AS BIGINT)) + 10, CAST(round(greatest(1, wc) * 1.2) AS BIGINT)) AS VARCHAR)
       || ' words.' || chr(10) END)"""


def _ptexts(spark, sf):
    """Texts to prompt for: conversation openings keyed by post id; lengths from the posts."""
    conv = tables.table(spark, sf, "conversations").filter("turn = 0").select(F.col("conv_id").alias("post_id"))
    posts = tables.posts(spark, sf).select(F.col("id").alias("post_id"), H.word_count("selftext").alias("selftext_word_count"))
    return conv, posts


_PT_SQL = f"""{POSTS_SQL},
conv AS (SELECT conv_id AS post_id FROM conversations WHERE turn = 0),
pw AS (SELECT id AS post_id, {S.word_count('selftext')} AS wc FROM posts),
al AS (SELECT c.post_id, pw.wc FROM conv c LEFT JOIN pw USING (post_id))"""


@register("length_band", f"WITH {_PT_SQL} SELECT post_id, {_LEN_SQL} AS length_line FROM al")
def q_length_band(spark, sf):
    conv, posts = _ptexts(spark, sf)
    return PR.attach_length(conv, posts).select("post_id", "length_line")


@register("attach_length", f"WITH {_PT_SQL} SELECT post_id, wc AS selftext_word_count, {_LEN_SQL} AS length_line FROM al")
def q_attach_length(spark, sf):
    conv, posts = _ptexts(spark, sf)
    a = PR.attach_length(conv, posts)
    return a.join(posts, "post_id", "left").select("post_id", "selftext_word_count", "length_line")


_SUMMARY_SQL = """su AS (SELECT conv_id AS post_id, text AS summary FROM conversations WHERE turn = 1 AND role = 'assistant')"""


def _summaries(spark, sf):
    return tables.table(spark, sf, "conversations").filter("turn = 1 AND role = 'assistant'").select(F.col("conv_id").alias("post_id"), F.col("text").alias("summary"))


@register(
    "attach_summary",
    f"WITH {_PT_SQL}, {_SUMMARY_SQL} SELECT al.post_id, su.summary FROM al JOIN su USING (post_id) WHERE su.summary IS NOT NULL AND su.summary <> ''",
)
def q_attach_summary(spark, sf):
    conv, posts = _ptexts(spark, sf)
    return PR.attach_summary(conv, _summaries(spark, sf)).select("post_id", "summary")


def _prompt_sql(tail, user=PR.USER_PROMPT):
    sp = S.q(f"SYSTEM PROMPT:\n{PR.SYSTEM_PROMPT}\n")
    up = S.q(f"USER PROMPT:\n{user}")
    return f"{sp} || {up} || {_LEN_SQL} || chr(10) || {tail} || chr(10)"


@register("build_prompt", f"WITH {_PT_SQL} SELECT post_id, {_prompt_sql(S.q(PR.CONSTRAINTS_BLOCK))} AS prompt FROM al")
def q_build_prompt(spark, sf):
    conv, posts = _ptexts(spark, sf)
    return PR.build_prompt(PR.attach_length(conv, posts), "generic").select("post_id", "prompt")


@register(
    "build_prompt_guided",
    f"""WITH {_PT_SQL}, {_SUMMARY_SQL}, g AS (SELECT al.*, su.summary FROM al JOIN su USING (post_id) WHERE su.summary IS NOT NULL AND su.summary <> '')
SELECT post_id, {_prompt_sql('summary', PR.GUIDED_PROMPT)} AS prompt FROM g""",
)
def q_build_prompt_guided(spark, sf):
    conv, posts = _ptexts(spark, sf)
    g = PR.attach_summary(PR.attach_length(conv, posts), _summaries(spark, sf))
    return PR.build_prompt(g, "guided").select("post_id", "prompt")


@register(
    "split_prompt",
    f"""WITH {_PT_SQL}, b AS (SELECT post_id, {_prompt_sql(S.q(PR.CONSTRAINTS_BLOCK))} AS prompt FROM al)
SELECT post_id, trim(regexp_extract(prompt, 'SYSTEM PROMPT:\\s*((?s).+?)\\nUSER PROMPT:', 1), ' ' || chr(9) || chr(10) || chr(13)) AS system,
       trim(regexp_extract(prompt, 'USER PROMPT:\\s*((?s).+)', 1), ' ' || chr(9) || chr(10) || chr(13)) AS "user" FROM b""",
)
def q_split_prompt(spark, sf):
    conv, posts = _ptexts(spark, sf)
    ok, _ = PR.split_prompts(PR.build_prompt(PR.attach_length(conv, posts), "generic"))
    return ok.select("post_id", "system", "user")


@register(
    "rename_by_index",
    f"""WITH {POSTS_SQL}, ix AS (SELECT doc_id AS hash, 't' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS name FROM labels)
SELECT p.id AS hash, ix.name FROM posts p JOIN ix ON ix.hash = p.id""",
)
def q_rename_by_index(spark, sf):
    ix = tables.table(spark, sf, "labels").select(F.col("doc_id").alias("hash"), H.zero_pad(F.col("doc_id"), 6, "t").alias("name"))
    posts = tables.posts(spark, sf).select(F.col("id").alias("hash"))
    matched, _ = PR.rename_by_index(posts, ix)
    return matched.select("hash", "name")


@register(
    "label_variables",
    f"""WITH {_LOAD} SELECT p.var, coalesce(i.lemma, p.var) AS word, coalesce(i.lemma, p.var) || ' (' || p.var || ')' AS label_full
FROM prim p LEFT JOIN idx i USING (var)""",
)
def q_label_variables(spark, sf):
    t, idx, hits, load, prim, *_ = _examples_inputs(spark, sf)
    lv = PR.label_variables(prim.select("var"), idx)
    return lv.select("var", "word", H.label_text(F.col("word"), F.col("var"), full=True).alias("label_full"))


@register(
    "pending",
    f"""WITH {_PT_SQL}, {_SUMMARY_SQL} SELECT post_id FROM al WHERE post_id NOT IN (SELECT post_id FROM su)""",
)
def q_pending(spark, sf):
    conv, _ = _ptexts(spark, sf)
    return PR.pending(conv, _summaries(spark, sf), "post_id")


@register("sample_first", f"WITH {POSTS_SQL} SELECT id, subreddit FROM posts ORDER BY id LIMIT 25")
def q_sample_first(spark, sf):
    return PR.sample_first(tables.posts(spark, sf).select("id", "subreddit"), 25)


def _echo_completer(system: str, user: str) -> str:
    """Deterministic local completer used by the registered query and tests."""
    return f"{len(system)}:{len(user)}"


@register(
    "batch_complete",
    f"""WITH {_PT_SQL}, b AS (SELECT post_id, {_prompt_sql(S.q(PR.CONSTRAINTS_BLOCK))} AS prompt FROM al),
sp AS (SELECT post_id, trim(regexp_extract(prompt, 'SYSTEM PROMPT:\\s*((?s).+?)\\nUSER PROMPT:', 1), ' ' || chr(9) || chr(10) || chr(13)) AS s,
              trim(regexp_extract(prompt, 'USER PROMPT:\\s*((?s).+)', 1), ' ' || chr(9) || chr(10) || chr(13)) AS u FROM b)
SELECT post_id AS id, CAST(length(s) AS VARCHAR) || ':' || CAST(length(u) AS VARCHAR) AS response, CAST(NULL AS VARCHAR) AS error, CAST(1 AS INTEGER) AS attempts FROM sp""",
)
def q_batch_complete(spark, sf):
    conv, posts = _ptexts(spark, sf)
    ok, _ = PR.split_prompts(PR.build_prompt(PR.attach_length(conv, posts), "generic"))
    return PR.batch_complete(ok, _echo_completer, key="post_id", workers=4, sleep=lambda s: None)


def _failing_completer():
    """Refuses prompts by their length: some always, some at the first request only."""
    refused = set()

    def complete(system: str, user: str) -> str:
        rule = len(user) % 5
        if rule == 0 or (rule == 1 and user not in refused):
            refused.add(user)
            raise ValueError("refused")
        refused.discard(user)
        return f"{len(system)}:{len(user)}"

    return complete


@register(
    "complete_job",
    f"""WITH {_PT_SQL}, b AS (SELECT post_id, {_prompt_sql(S.q(PR.CONSTRAINTS_BLOCK))} AS prompt FROM al),
sp AS (SELECT post_id, trim(regexp_extract(prompt, 'SYSTEM PROMPT:\\s*((?s).+?)\\nUSER PROMPT:', 1), ' ' || chr(9) || chr(10) || chr(13)) AS s,
              trim(regexp_extract(prompt, 'USER PROMPT:\\s*((?s).+)', 1), ' ' || chr(9) || chr(10) || chr(13)) AS u FROM b),
r AS (SELECT *, length(u) % 5 AS rule, (SELECT count(*) FROM sp o WHERE o.post_id < sp.post_id) < 20 AS early FROM sp)
SELECT post_id AS id, CASE WHEN rule > 0 THEN CAST(length(s) AS VARCHAR) || ':' || CAST(length(u) AS VARCHAR) END AS response,
       CASE WHEN rule = 0 THEN 'ValueError: refused' END AS error,
       CAST(CASE WHEN rule = 0 THEN 3 * (CASE WHEN early THEN 2 ELSE 1 END) WHEN rule = 1 THEN 2 ELSE 1 END AS INTEGER) AS attempts,
       CAST(CASE WHEN rule = 0 AND early THEN 2 ELSE 1 END AS INTEGER) AS runs FROM r""",
)
def q_complete_job(spark, sf):
    """P3 + P4: a test run of the first 20, then the whole job, which asks again only for what has no response."""
    conv, posts = _ptexts(spark, sf)
    ok, _ = PR.split_prompts(PR.build_prompt(PR.attach_length(conv, posts), "generic"))
    out = f"{checkpoint_dir(spark).rstrip('/')}/textdims-io/job-{uuid.uuid4().hex}"
    for first in (20, None):
        done = PR.complete_job(ok, _failing_completer(), out, key="post_id", first=first, max_attempts=3, sleep=lambda s: None)
    return done


# --- language identification (P2) ------------------------------------------------
_LANG_SQL = f"""{POSTS_SQL},
w3 AS (SELECT id, language, w FROM (SELECT id, language,
        unnest(string_split_regex(trim(regexp_replace(lower(selftext), '\\s+', ' ', 'g')), ' ')) AS w FROM posts WHERE selftext IS NOT NULL) WHERE w <> ''),
g3 AS (SELECT id, language, substr(' ' || w || ' ', o + 1, 3) AS gram FROM (
        SELECT id, language, w, unnest(generate_series(0, length(w) + 2 - 3)) AS o FROM w3)),
pc AS (SELECT language AS lang, gram, count(*) AS c FROM g3 WHERE language IS NOT NULL AND id % 2 = 0 GROUP BY ALL),
voc AS (SELECT count(DISTINCT gram) AS v FROM pc),
lt AS (SELECT lang, sum(c) AS t FROM pc GROUP BY lang),
prof AS (SELECT pc.lang, pc.gram, ln((pc.c + 1.0) / (CAST(lt.t AS DOUBLE) + voc.v)) AS logp, ln(1.0 / (CAST(lt.t AS DOUBLE) + voc.v)) AS dflt
         FROM pc JOIN lt USING (lang) CROSS JOIN voc),
tg AS (SELECT id, gram, count(*) AS c FROM g3 GROUP BY ALL),
nt AS (SELECT id, sum(c) AS n FROM tg GROUP BY id),
seen AS (SELECT tg.id, prof.lang, sum(tg.c * (prof.logp - prof.dflt)) AS gain FROM tg JOIN prof USING (gram) GROUP BY ALL),
dl AS (SELECT DISTINCT lang, dflt FROM prof),
sc AS (SELECT nt.id, dl.lang, nt.n * dl.dflt + coalesce(seen.gain, 0.0) AS score FROM nt CROSS JOIN dl LEFT JOIN seen ON seen.id = nt.id AND seen.lang = dl.lang),
best AS (SELECT id, arg_min(lang, struct_pack(s := -score, l := lang)) AS language FROM sc GROUP BY id)"""


_TRAIN = "id % 2 = 0"


@register("detect_language", f"WITH {_LANG_SQL} SELECT p.id, coalesce(b.language, 'unknown') AS language FROM posts p LEFT JOIN best b USING (id)")
def q_detect_language(spark, sf):
    p = tables.posts(spark, sf)
    return LG.train_and_detect(p, "id", "selftext", "language", train=_TRAIN)


@register(
    "language_accuracy",
    f"""WITH {_LANG_SQL}, d AS (SELECT p.id, p.language AS truth, coalesce(b.language, 'unknown') AS detected FROM posts p LEFT JOIN best b USING (id))
SELECT truth, count(*) AS n, CAST(sum(CASE WHEN truth = detected THEN 1 ELSE 0 END) AS BIGINT) AS n_correct FROM d WHERE id % 2 = 1 GROUP BY truth""",
)
def q_language_accuracy(spark, sf):
    p = tables.posts(spark, sf)
    # trained on one half of the labelled rows, counted on the other
    d = LG.train_and_detect(p, "id", "selftext", "language", train=_TRAIN).filter(f"NOT ({_TRAIN})").join(p.select("id", F.col("language").alias("truth")), "id")
    return d.groupBy("truth").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("truth") == F.col("language")).cast("long")).alias("n_correct"))


# --- corpus size (D9, B20) ---------------------------------------------------------
@register(
    "corpus_size",
    f"""WITH {_TOK_SQL},
tw AS (SELECT text_id, sum(len(list_filter(string_split_regex(line, '\\s+'), lambda x: x <> ''))) AS n FROM (
       SELECT text_id, word || chr(9) || tag || chr(9) || lemma AS line FROM tl) WHERE regexp_matches(line, '^[A-Za-z]') GROUP BY text_id),
d AS (SELECT {tables.folder_sql('lang')} AS folder, 't' || lpad(CAST(doc_id AS VARCHAR), 4, '0') AS name, coalesce(n, 0) AS n
      FROM documents LEFT JOIN tw ON tw.text_id = documents.doc_id),
c AS (SELECT CASE WHEN folder = 'human' THEN 'human' ELSE 'ai' END AS source, folder AS model,
             CASE WHEN regexp_matches(substr(name, 2, 2), '^[0-9]{{2}}$') THEN substr(name, 2, 2) ELSE 'unknown' END AS season,
             CAST(n AS BIGINT) AS n_words FROM d),
g AS (SELECT grouping(source, model, season) AS gid, source, model, season, count(*) AS n_texts, CAST(sum(n_words) AS BIGINT) AS n_words
      FROM c GROUP BY GROUPING SETS ((source), (model), (source, model), (season), ()))
SELECT CASE gid WHEN 3 THEN 'source' WHEN 5 THEN 'model' WHEN 1 THEN 'source/model' WHEN 6 THEN 'season' ELSE 'overall' END AS kind,
       CASE gid WHEN 3 THEN source WHEN 5 THEN model WHEN 1 THEN source || '/' || model WHEN 6 THEN season ELSE 'overall' END AS key,
       n_texts, n_words FROM g""",
)
def q_corpus_size(spark, sf):
    t = tables.texts(spark, sf).withColumn("name", H.zero_pad(F.col("text_id"), 4, "t"))
    return CO.corpus_size(CO.corpus_texts(t, words=CO.tagged_words(F.col("text"))))


@register(
    "derive_season",
    "SELECT doc_id AS text_id, CASE WHEN regexp_matches(substr(name, 2, 2), '^[0-9]{2}$') THEN substr(name, 2, 2) ELSE 'unknown' END AS season "
    "FROM (SELECT doc_id, 't' || CAST(doc_id AS VARCHAR) AS name FROM documents)",
)
def q_derive_season(spark, sf):
    t = tables.texts(spark, sf)
    return t.select("text_id", H.derive_season(F.concat(F.lit("t"), F.col("text_id").cast("string"))).alias("season"))


@register(
    "preview_outliers",
    f"WITH {POSTS_SQL}, {_FENCES} SELECT id, {preview_sql('selftext', 400)} AS preview FROM w, g WHERE n_words < lo OR n_words > hi",
)
def q_preview_outliers(spark, sf):
    p = tables.posts(spark, sf).withColumn("n_words", H.word_count("selftext"))
    return CL.iqr_outliers(p, "n_words", "selftext", 400).select("id", "preview")


# --- remaining inventory items --------------------------------------------------------
@register(
    "with_available_text",
    f"""WITH {_LOAD}
SELECT s.text_id, s.factor, s.score FROM scores s WHERE s.text_id IN (SELECT doc_id FROM labels)""",
)
def q_with_available_text(spark, sf):
    *_, scores, groups = _examples_inputs(spark, sf)
    lbl = tables.table(spark, sf, "labels").select(F.col("doc_id").alias("text_id"))
    avail, _ = EX.with_available_text(scores, lbl)
    return avail.select("text_id", "factor", "score")


@register(
    "missing_texts",
    f"""WITH {_LOAD}
SELECT DISTINCT s.text_id FROM scores s WHERE s.text_id NOT IN (SELECT doc_id FROM labels)""",
)
def q_missing_texts(spark, sf):
    *_, scores, groups = _examples_inputs(spark, sf)
    lbl = tables.table(spark, sf, "labels").select(F.col("doc_id").alias("text_id"))
    return EX.with_available_text(scores, lbl)[1]


@register(
    "attach_group_means",
    f"""WITH {_EX_SQL}, sg AS (SELECT s.text_id, s.factor, s.score, g.grp FROM scores s JOIN grp g USING (text_id))
SELECT sg.text_id, CAST(sg.factor AS INTEGER) AS factor, sg.score, sg.grp AS "group", round(gm.mean, 6) AS mean
FROM sg LEFT JOIN gm ON gm.factor = sg.factor AND gm.grp = sg.grp""",
)
def q_attach_group_means(spark, sf):
    *_, scores, groups = _examples_inputs(spark, sf)
    means = EX.group_means(scores, groups).select("factor", "group", "mean")
    j = EX.attach_group_means(scores.join(groups, "text_id"), means)
    return j.select("text_id", F.col("factor").cast("int").alias("factor"), "score", "group", F.round("mean", 6).alias("mean"))


@register(
    "normalize_levels",
    f"SELECT doc_id AS text_id, lower(trim('  ' || upper({tables.folder_sql('lang')}) || ' ')) AS level FROM documents",
)
def q_normalize_levels(spark, sf):
    t = tables.texts(spark, sf)
    return t.select("text_id", H.normalize_level(F.concat(F.lit("  "), F.upper("folder"), F.lit(" "))).alias("level"))


@register("parse_pole_list", f'WITH {_LOAD} SELECT factor, CAST(pole AS INTEGER) AS pole, word AS item, CAST(fl AS DOUBLE) AS loading, is_primary AS "primary" FROM ent2')
def q_parse_pole_list(spark, sf):
    _, idx, _, load = _loaded(spark, sf)
    fl = FA.factor_lists(FA.factor_entries(load, idx.select("var", "lemma"), CUT))
    return fl.select("factor", "pole", F.explode(EX.parse_pole_list(F.col("words"))).alias("e")).select("factor", "pole", "e.*")


@register(
    "char_ngrams",
    f"""WITH {POSTS_SQL},
w AS (SELECT id, w FROM (SELECT id, unnest(string_split_regex(trim(regexp_replace(lower(selftext), '\\s+', ' ', 'g')), ' ')) AS w FROM posts) WHERE w <> ''),
g1 AS (SELECT id, ' ' || w || ' ' AS p, n FROM w, (VALUES (4), (5), (6)) t(n)),
gr AS (SELECT id, substr(p, o + 1, n) AS gram FROM (SELECT id, p, n, unnest(generate_series(0, length(p) - n)) AS o FROM g1)
       UNION ALL SELECT id, ' ' || w || ' ' FROM w WHERE length(w) + 2 < 4)
SELECT id, count(*) AS n_grams, count(DISTINCT gram) AS n_distinct FROM gr GROUP BY id""",
)
def q_char_ngrams(spark, sf):
    return CL.gram_sizes(tables.posts(spark, sf), H.char_wb_ngrams(F.col("selftext")))


@register(
    "review_table",
    f"WITH {POSTS_SQL} SELECT CAST(id AS VARCHAR) AS id, subreddit, language FROM posts",
)
def q_review_table(spark, sf):
    from ..session import checkpoint_dir
    from ..sources import files as FI
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/textdims-io/review-{uuid.uuid4().hex}"
    FI.export_review_table(tables.posts(spark, sf), ["id", "subreddit", "language"], path)
    return spark.read.option("header", "true").schema("id string, subreddit string, language string").csv(path)
