"""Example rendering: tagged lemmas, secondary lemmas, the plain rendering."""

from textdims.operators import examples as EX


def _examples(spark):
    return spark.createDataFrame([(1, 1, 1, 7, 3), (2, -1, 1, 8, -1)], "factor int, pole int, ex_id int, text_id long, score long")


def test_marks_follow_the_tagged_lemma(spark):
    texts = spark.createDataFrame([(7, "Berlin likes trees. Trees like berlin!"), (8, "nothing x9 here")], "text_id long, text string")
    lemmas = spark.createDataFrame([(1, 1, "berlin"), (1, 1, "trees"), (2, -1, "x9"), (2, -1, "recorded")], "factor int, pole int, lemma string")
    got = {r.text_id: (r.paragraphs, r.matched_lemmas) for r in EX.annotate_examples(_examples(spark), texts, lemmas).collect()}
    # a proper noun keeps its case as a lemma, a form with a digit has none
    assert got[7] == ("Berlin likes \\textbf{trees}.\nTrees like \\textbf{berlin}!", "berlin, trees")
    assert got[8] == ("nothing x9 here", "")


def test_plain_rendering_and_uncovered_pairs(spark):
    texts = spark.createDataFrame([(7, "human", "human", "human/t7.txt", "Full\ntext."), (8, "ai", "gpt", "gpt/t8.txt", "Other.")], "text_id long, group string, model string, file string, text string")
    used = spark.createDataFrame([(7, 1, 1, 2, "a, b")], "text_id long, factor int, pole int, n long, words string")
    docs, uncovered = EX.plain_examples(_examples(spark), texts, used)
    got = {r.text_id: r.document for r in docs.collect()}
    assert got[7] == "Text ID: 7\nGroup: human\nModel: human\nFile:   human/t7.txt\n\nScore (f1_pos): 3\nLoading words (f1_pos), N=2: a, b\nFull\ntext."
    assert got[8].splitlines()[5:7] == ["Score (f2_neg): -1", "Loading words (f2_neg), N=0: "]
    assert [tuple(r) for r in uncovered.collect()] == [(8, 2, -1)]


def test_pole_list_items(spark):
    row = spark.createDataFrame([("w (.45), (z (-.31)), v000001 (1.05)",)], "s string").select(EX.parse_pole_list("s").alias("x")).first()["x"]
    assert [(i["item"], i["loading"], i["primary"]) for i in row] == [("w", 0.45, True), ("z", -0.31, False), ("v000001", 1.05, True)]


def test_corpus_size_counts_tagged_lines(spark):
    from pyspark.sql import functions as F

    from textdims.operators import corpus as CO

    df = spark.createDataFrame([("a07x", "human", "Two cats, 9 dogs!", "Two\tCD\ttwo\ncats\tNNS\tcat\n,\tPUN\t,\n9\tCD\t9\ndogs\tNNS\tdog\n!\tSENT\t!")], "name string, folder string, text string, tagged string")
    want = CO.corpus_texts(df, text_col="tagged").first()
    assert (want.season, want.n_words) == ("07", 9)
    assert CO.corpus_texts(df, words=CO.tagged_words(F.col("text"))).first().n_words == 9
    assert CO.corpus_texts(df, words=CO.tagged_words(F.col("text"), "tokens")).first().n_words == 3
