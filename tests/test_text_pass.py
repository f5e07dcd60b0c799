"""Queries whose work has to grow with the tables: files of a bounded size, no token dealt anew, values measured once, words tested once."""

from pyspark.sql import functions as F

from textdims.operators import clean as CL
from textdims.operators import keyness as K
from textdims.operators import tokens as T
from textdims.plans import QUERIES, q_io


def _documents(spark, path, n):
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("Some words of text "), F.col("id").cast("string")).alias("text"),
                                 F.lit("en").alias("lang"), F.lit("src1").alias("source"), F.lit(20).cast("long").alias("n_chars"))
    rows.write.parquet(f"{path}/documents.parquet")


def test_files_of_a_batch_grow_with_the_rows(spark, tmp_path, monkeypatch):
    _documents(spark, tmp_path, 100)
    monkeypatch.setattr(q_io, "FILE_ROWS", 10)
    monkeypatch.setattr(q_io, "_scratch", lambda spark, name: str(tmp_path / name))
    row = QUERIES["run_counts"](spark, str(tmp_path)).first()
    assert (row.n_batches, row.n_rows, row.adds_up) == (3, 100, True)
    assert len(list((tmp_path / "stream" / "in").glob("part-*.json"))) == 12


def test_detokenize_deals_texts_not_tokens(spark, tmp_path):
    _documents(spark, tmp_path, 3)
    df = QUERIES["detokenize"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")
    assert {(r.text_id, r.text) for r in df.collect()} == {(k, f"Some words of text {k}") for k in range(3)}


def test_outliers_read_measured_values(spark):
    df = spark.createDataFrame([(k, "w " * (200 if k == 7 else 10 + k % 3)) for k in range(20)], "id long, text string")
    out = CL.iqr_outliers(CL.with_word_count(df, "text"), "n_words", "text")
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.id, r.n_words) for r in out.collect()] == [(7, 200)]


def test_tagged_tokens_of_many_folders(spark, tmp_path):
    rows = [(1, "one Two.", "en"), (2, "three", "de"), (3, "four five", "en"), (4, None, "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1)).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    got = {(r.folder, r.tag): r.n for r in QUERIES["tagged_roundtrip"](spark, str(tmp_path)).collect()}
    assert got == {("human", "IN"): 1, ("human", "NP"): 1, ("human", "SENT"): 1, ("human", "NN"): 1, ("human", "JJ"): 1, ("generic_gpt", "NN"): 1}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


WORDS = ["The cat saw a CAT, Be Been be 12 a1 1b2 x_y _ Ly Early early EARLY sing Ing ing ed Ed It it IT Is", "İx İxy iPhone IPHONE Bed bed of Of OF Ab ab aB A ΟΔΟΣ οδοσ ǅa Ⅷa 𐐀b 𐐨b ab𐐀 İİ a", "Élan élan Ét ét Do doing DOING Have having 東京 Ⅷ", "", None]


def test_words_are_tested_after_their_counts(spark):
    rows = [(k, s, x) for k, x in enumerate(WORDS) for s in ("s", None)] + [(1, "s", WORDS[0]), (None, "s", WORDS[1])]
    texts = spark.createDataFrame(rows, "text_id long, stratum string, text string").coalesce(1)
    each = texts.withColumn("_row", F.monotonically_increasing_id()).localCheckpoint()
    tokens = T.content_tokens(T.tag_tokens(each, keys=("_row", "text_id", "stratum"))).filter(F.col("word").rlike(r"^[\p{L}\p{N}_]+$"))
    want = tokens.select("_row", "text_id", "stratum", F.col("lemma_lc").alias("lemma")).distinct()
    got = T.text_lemmas(each, keys=("_row", "text_id", "stratum"))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    words = T.text_words(texts)
    assert sorted(map(str, K.doc_frequency(words).collect())) == sorted(map(str, K.doc_frequency(want).collect()))
    assert sorted(map(str, K.keyness(words, texts).collect())) == sorted(map(str, K.keyness(want, texts).collect()))


def test_no_content_test_before_the_counts(spark, tmp_path):
    _documents(spark, tmp_path, 3)
    for name in ("consolidate", "keyness", "doc_frequency"):
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index(r"\p{L}.*\p{L}") < plan.index("Aggregate [word"), name
        assert plan.count(r"\p{L}.*\p{L}") == 1, name
