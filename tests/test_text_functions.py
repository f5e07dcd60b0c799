"""Scalar functions: hand-computed literals (FIXTURES.md section 3) and brute-force rules."""

import random
import re

from pyspark.sql import functions as F

from textdims.functions import text as H
from textdims.operators import tokens as T


def _one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_length_band(spark):
    data = [(5,), (20,), (100,), (333,), (None,)]
    out = _one(spark, H.length_line(F.col("wc")), data, "wc long")
    assert out == [
        "- Length: 10–20 words.\n",
        "- Length: 16–26 words.\n",
        "- Length: 80–120 words.\n",
        "- Length: 266–400 words.\n",
        "- Length: 120–500 words.\n",
    ]


def test_fmt_loading(spark):
    out = _one(spark, H.fmt_loading(F.col("x")), [(0.45,), (-0.62,), (1.05,)], "x double")
    assert out == [".45", "-.62", "1.05"]


def test_strata(spark):
    df = spark.createDataFrame([("human",), ("generic_gpt",), ("summary_guided_gpt",)], "f string")
    rows = df.select(H.stratum_source("f"), H.stratum_prompt("f"), H.stratum_model("f")).collect()
    assert [tuple(r) for r in rows] == [
        ("human", "human", "human"),
        ("ai", "generic", "gpt"),
        ("ai", "summary_guided", "gpt"),
    ]
    g = df.select(H.derive_group(H.stratum_source("f"), H.stratum_prompt("f"), H.stratum_model("f"))).collect()
    assert [r[0] for r in g] == ["human", "generic_gpt", "summary_guided_gpt"]


def test_content_lemma_rules(spark):
    data = [("Xyz", "NN", "<unknown>"), ("a1", "NN", "a1"), ("is", "VBZ", "be"), ("slowly", "RB", "slowly")]
    df = spark.createDataFrame(data, "word string, tag string, lemma string")
    out = [r[0] for r in df.select(T.content_lemma(F.col("word"), F.col("tag"), F.col("lemma"))).collect()]
    assert out == ["xyz", None, None, None]


def test_word_count_matches_python(spark):
    texts = ["Hello, wörld! 42 times_two", "", "   ", "ça va? ÉTÉ-été", "a\nb\tc"]
    got = _one(spark, H.word_count(F.col("t")), [(t,) for t in texts], "t string")
    assert got == [len(re.findall(r"\b\w+\b", t)) for t in texts]


def _char_wb(text, lo=4, hi=6):
    text = re.sub(r"\s\s+", " ", text.lower())
    out = []
    for w in text.split():
        w = " " + w + " "
        for n in range(lo, hi + 1):
            off = 0
            out.append(w[off:off + n])
            while off + n < len(w):
                off += 1
                out.append(w[off:off + n])
            if off == 0:
                break
    return out


def test_char_wb_ngrams_brute_force(spark):
    random.seed(7)
    alphabet = "ab cdé!  \n xyz1"
    samples = ["", "a", "ab", "abcd", "hello world", "x  y\nz"] + [
        "".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(200)
    ]
    got = _one(spark, H.char_wb_ngrams(F.col("t")), [(s,) for s in samples], "t string")
    for s, g in zip(samples, got):
        assert sorted(g) == sorted(_char_wb(s)), s


def test_normalize_template(spark):
    s = "Visit https://x.y/z NOW!!! Age 42,, ok..  \n fine??"
    got = _one(spark, H.normalize_template(F.col("t")), [(s,)], "t string")[0]
    expect = s.lower()
    expect = re.sub(r"(https?://\S+|www\.\S+)", " URL ", expect)
    expect = re.sub(r"\s+", " ", expect).strip()
    expect = re.sub(r"\d+", " NUM ", expect)
    expect = re.sub(r"([!?.,])\1+", r"\1", expect)
    assert got == expect


def test_slug(spark):
    got = _one(spark, H.slug(F.col("t")), [("  new_100_a+b c  ",), ("___",), ("x/y",)], "t string")
    assert got == ["new_100_a_b_c", "run", "x_y"]


def test_split_sentences_and_detokenize(spark):
    got = _one(spark, H.split_sentences(F.col("t")), [("One. Two! three? Four",)], "t string")[0]
    assert got == ["One.", "Two! three?", "Four"]
    d = _one(spark, H.detokenize(F.col("a")), [(["I", "do", "n't", "know", ",", "ok", "."],)], "a array<string>")[0]
    assert d == "I don't know, ok."


def _value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_printed_numbers_are_those_of_python(spark):
    values = [0.285, 0.125, -0.125, 0.375, 1.005, 2.675, 0.45, -0.62, 1.05, 0.0, -0.001, 12345.678, 0.5, 1e-9]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(H.printed("v", 2).alias("p"), H.fmt_loading("v").alias("f")).collect()
    assert [r.p for r in rows] == [f"{v:.2f}" for v in values]
    assert [r.f for r in rows][:3] == [".28", ".12", "-.12"]


def test_no_break_space_is_white_space(spark):
    nb = "\u00a0"
    assert _value(spark, H.normalize_template(F.lit(f"see http://a.b{nb}rest 12"))) == "see URL rest  NUM "
    assert _value(spark, H.split_sentences(F.lit(f"A b.{nb}C d.\n"))) == ["A b.", "C d."]
    assert _value(spark, H.detokenize(F.array(F.lit("is"), F.lit("n't"), F.lit("it"), F.lit(f"{nb}?")))) == "isn't it?"
    assert _value(spark, H.strip(F.lit(f"{nb}\t x y \n"))) == "x y"
