import zlib

import numpy as np

from textdims.llm import language_id as lid
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from .helpers import ODD, docs

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, SF).collect()}
    rows = table(spark, SF, "documents").collect()
    assert len(got) == len(rows)
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"] and len(r["text"]) > 100]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= g["score"] <= 1 for g in got.values())


def test_odd_rows_and_empty_tables(spark):
    model = lid.fit(table(spark, SF, "documents"))
    out = lid.predict(docs(spark, ODD), model).collect()
    assert len(out) == len(ODD)
    assert {(r["doc_id"], r["lang_pred"], r["score"]) for r in out if r["doc_id"] in (1, 2, 3)} == {(i, "und", 0.0) for i in (1, 2, 3)}
    assert lid.predict(docs(spark, []), model).count() == 0
    assert lid.fit(docs(spark, [])) is None
    assert {r["lang_pred"] for r in lid.predict(docs(spark, ODD), None).collect()} == {"und"}


def test_one_language(spark):
    model = lid.fit(docs(spark, [(i, "some words of one language") for i in range(20)]))
    assert {r["lang_pred"] for r in lid.predict(docs(spark, [(1, "other text"), (2, "12 34")]), model).collect()} == {"en", "und"}


def test_vectors_do_not_depend_on_slices():
    data = np.frombuffer(("äbc def " * 1000).encode(), np.uint8)
    whole = lid.vectors(np.array([0, len(data)]), data)
    before, lid._SLICE = lid._SLICE, 1000
    try:
        assert np.allclose(whole, lid.vectors(np.array([0, len(data)]), data))
    finally:
        lid._SLICE = before


def test_machines_separate():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x @ np.arange(5) > 0, 1.0, -1.0)
    w, b = lid.linear_svm(x, y)
    assert np.mean(np.sign(x @ w + b) == y) > 0.98


def test_numerals_are_no_letters(spark):
    df = docs(spark, [(1, "plain words of a language"), (2, "\u00b2 \u00bd \u2167 \u2460 12 _"), (3, None), (4, "\u6587")])
    model = lid.fit(df)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lid.predict(df, model).collect()}
    assert got[2] == got[3] == ("und", 0.0) and got[1][0] == got[4][0] == "en"
