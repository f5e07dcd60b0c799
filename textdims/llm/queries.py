"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import numpy
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversation_repair, decontaminate, exact_dedup, language_id, license_scan, line_dedup, quality, secret_scan, simhash, source_divergence, token_counts, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return put


#: Documents with more tokens than this are over the limit of ``op1``.
TOKEN_LIMIT = 1024
#: From these scores on, a document counts as good (``op4``), as toxic (``op6``).
GOOD, TOXIC = 0.3, 0.5


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, keep=~language_id.held_out())
    return language_id.predict(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), keep=~quality.held_out())
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~toxicity.held_out())
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def bpe_digest(both: DataFrame, *more) -> DataFrame:
    """doc_id, n_tokens, ``more`` and the digests of ``bpe.decode``'s rows."""
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        *more,
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(bpe.encode_and_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")))


@query(
    "op8_line_dedup",
    """
    WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
         w AS (SELECT doc_id, p, l[p] || chr(10) || l[p + 1] || chr(10) || l[p + 2] AS win
               FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM t)),
         f AS (SELECT win, min((doc_id, p)) AS first FROM w GROUP BY win HAVING count(*) > 1),
         c AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS q FROM w JOIN f USING (win) WHERE (doc_id, p) <> first),
         k AS (SELECT doc_id, q, l[q] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS q FROM t) ANTI JOIN c USING (doc_id, q)),
         r AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY q) AS text FROM k GROUP BY doc_id)
    SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(text, '') AS text
    FROM t LEFT JOIN r USING (doc_id)
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op9_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
         g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM t JOIN g USING (norm)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_groups(table(spark, sf_dir, "documents"))


_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op10_decontaminate",
    f"""
    WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
         iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
                FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
         d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
         dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
                      FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
         hit AS (SELECT doc_id, p, n, item FROM dw JOIN iw USING (n, win)),
         place AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
         item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN place USING (doc_id) LEFT JOIN item USING (doc_id)
    """,
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.hit_counts(found)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with about a quarter of its turns dropped, emptied, stripped of their ends, repeated or given to the user."""
    none = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), none), F.lit(":"), F.coalesce(F.col("turn").cast("string"), none))
    how = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), none)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(how == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), none)).alias("role"),
        F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copy", "copies")


_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length({key}) + 1), lambda i: CAST(ord({key}[i]) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _edit(cost: str, letter: str, after: str) -> str:
    """Cost and audit as one string that sorts by both: ten digits, a colon, the letters."""
    return f"(lpad(CAST(CAST(substr({after}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || ':{letter}' || substr({after}, 12))"


def _step(state: str, follows: str, role: str, first: str = "") -> str:
    """The best way on from a state without an insertion before the turn."""
    return f"""least({_edit("2", "D", state)}, CASE WHEN NOT gone AND i = '{role}' THEN {_edit("more", "K", follows)} END,
        {first}CASE WHEN NOT gone THEN {_edit("more + 1", "R", follows)} END)"""


_FIRST_SYSTEM = f"CASE WHEN NOT gone AND i = 's' THEN {_edit('more', 'K', 'vs')} END, "

_REPAIR_SQL = rf"""
    WITH RECURSIVE h AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_CRC32.format(key="(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS how FROM conversations),
    r AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
                 CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k FROM r),
    f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
                         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault,
                    substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS i0 FROM o),
    n AS (SELECT *, fault IN ('b', 'd') AS gone, CASE fault WHEN 't' THEN 5 ELSE 0 END AS more FROM f),
    c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (i0 IS NOT NULL AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
    v AS (SELECT conv_id, n + 1 AS k, '0000000000:' AS v0, '0000000010:II' AS vs, '0000000005:I' AS vu, '0000000000:' AS va FROM c
          UNION ALL
          SELECT conv_id, k, least(b0, {_edit("5", "I", f"least(bu, {_edit('5', 'I', 'ba')})")}), least(bs, {_edit("5", "I", f"least(bu, {_edit('5', 'I', 'ba')})")}),
                 least(bu, {_edit("5", "I", "ba")}), least(ba, {_edit("5", "I", "bu")})
          FROM (SELECT n.conv_id, n.k, {_step("v0", "vu", "u", _FIRST_SYSTEM)} AS b0, {_step("vs", "vu", "u")} AS bs,
                       {_step("vu", "va", "a")} AS bu, {_step("va", "vu", "u")} AS ba
                FROM v JOIN n ON n.conv_id IS NOT DISTINCT FROM v.conv_id AND n.k = v.k - 1)),
    a AS (SELECT conv_id, CAST(substr(v0, 1, 10) AS BIGINT) AS cost, substr(v0, 12) AS audit FROM v WHERE k = 1),
    e AS (SELECT conv_id, p, audit[p] AS x, length(replace(substr(audit, 1, p), 'I', '')) AS k FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM a)),
    l AS (SELECT e.conv_id, p, x, role, i, CASE WHEN x = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS j,
                 first_value(x = 'K' AND i = 's') OVER (PARTITION BY e.conv_id ORDER BY p) AS opened
          FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.k = e.k AND x <> 'I' WHERE x <> 'D'),
    t AS (SELECT conv_id, string_agg((CASE WHEN x = 'K' THEN role WHEN (j - CASE WHEN opened THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY p) AS text
          FROM l GROUP BY conv_id),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
    FROM ids LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM ids.conv_id
         LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id
    """


@query("op12_conversation_repair", _REPAIR_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    done = conversation_repair.repair(damage(conversations)).withColumnRenamed("conv_id", "id")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return ids.join(done, F.col("conv_id").eqNullSafe(F.col("id")), "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


def _scan_sql() -> str:
    """Phrases by their places; templates by running counts of the words that are new in the block of each start."""
    words = [(label, license_scan.words_of(text.encode()), share) for label, text, share in license_scan.TEMPLATES]
    kept = license_scan.Scanner(license_scan.TEMPLATES, {})
    kept.order(numpy.zeros(len(kept.number), numpy.int64))
    tp = ", ".join(f"({k}, '{label}', {len(w)}, {len(set(w))}, {t.asked})" for k, ((label, w, _), t) in enumerate(zip(words, kept.templates, strict=True)))
    tw = ", ".join(f"({k}, '{x.decode()}')" for k, (_, w, _) in enumerate(words) for x in sorted(set(w)))
    places = []
    for phrase, label in license_scan.PHRASES.items():
        w = phrase.split()
        same = " AND ".join(f"w[p + {k}] = '{x}'" for k, x in enumerate(w))
        places.append(f"SELECT r, '{label}' AS label, p - 1 AS start FROM (SELECT r, w, unnest(range(1, len(w) - {len(w) - 2})) AS p FROM d) WHERE {same}")
    return f"""
    WITH tp(t, label, size, m, asked) AS (VALUES {tp}), tw(t, word) AS (VALUES {tw}),
         d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
         x AS (SELECT r, t, j, n, word, size FROM (SELECT r, len(w) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS j FROM d) JOIN tw USING (word) JOIN tp USING (t)),
         y AS (SELECT r, t, least(j, greatest(0, n - size)) AS high, greatest(0, j - size + 1, coalesce(lag(j) OVER (PARTITION BY r, t, word ORDER BY j) + 1, 0)) AS low FROM x),
         e AS (SELECT r, t, low AS s, 1 AS step FROM y WHERE low <= high UNION ALL SELECT r, t, high + 1, -1 FROM y WHERE low <= high),
         c AS (SELECT r, t, sum(sum(step)) OVER (PARTITION BY r, t ORDER BY s) AS n FROM e GROUP BY r, t, s),
         b AS (SELECT r, label, max(n) / CAST(any_value(m) AS DOUBLE) AS score FROM c JOIN tp USING (t) GROUP BY r, t, label HAVING max(n) >= any_value(asked)),
         p AS ({" UNION ALL ".join(places)}),
         pl AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY r),
         al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM p UNION ALL SELECT r, label FROM b) GROUP BY r),
         sc AS (SELECT r, max(score) AS score FROM b GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS score
    FROM d LEFT JOIN pl USING (r) LEFT JOIN al USING (r) LEFT JOIN sc USING (r)
    """


@query("op11_license_scan", _scan_sql())
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.label_digest(license_scan.find_licenses(table(spark, sf_dir, "documents")))


@query(
    "op13_source_divergence",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS ts FROM documents),
         t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
         k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
         l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
         g AS (SELECT DISTINCT lang, source FROM d),
         c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
         s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
         p AS (SELECT g.lang, g.source, k.term, c.n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (CAST(coalesce(s.total, 0) AS HUGEINT) + 2 * v) AS p,
                      1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (CAST(l.total AS HUGEINT) + 2 * v) AS q
               FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
         w AS (SELECT lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
               FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
         pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
                   FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN w ON w.lang = a.lang AND w.source = a.source AND w.other = b.source),
         terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10
    """,
)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))
