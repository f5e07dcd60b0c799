import zlib

import numpy as np
import pytest

from textdims.llm import toxicity as t
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from .helpers import ODD, docs

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return t.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), keep=~t.held_out())


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, SF).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for d, r in got.items())
    held = [d for d in labels if got[d]["held_out"]]
    # some rows are labelled toxic without any toxic word
    assert np.mean([got[d]["predicted"] for d in held if labels[d]]) > 0.88
    assert np.mean([got[d]["predicted"] for d in held if not labels[d]]) < 0.01


def test_disguised_words_are_restored(model):
    r = t.Restorer(model.logp)
    for seen, word in {"1d10t": "idiot", "!d10t": "idiot", "$tupid": "stupid", "m0r0n": "moron", "tr@sh": "trash", "stuuuupid": "stupid", "i.d.i.o.t": "idiot", "l0s3r,": "loser"}.items():
        assert r.words(seen) == (word,), seen
    assert r.text("you s t u p i d one") == "you stupid one"
    for plain in ("thention", "on", "2024", "100", "a", "the.", "von!", "êtes"):
        assert [w.lower() for w in r.words(plain)] == [plain.strip(".!")]


def test_disguised_documents_score_like_plain_ones(spark, model):
    clean = next(r["text"] for r in table(spark, SF, "documents").orderBy("doc_id").collect() if 500 < len(r["text"]) < 1500 and "idiot" not in r["text"])
    rows = [(1, clean), (2, clean + " stupid idiot moron loser"), (3, clean + " $tup1d 1d10t m0r0n l0s3r"), (4, clean + " s t u p i d and i d i o t with m o r o n")]
    got = {r["doc_id"]: r["score"] for r in t.score(docs(spark, rows), model).collect()}
    assert got[1] < 0.5 <= min(got[2], got[3], got[4])


def test_odd_rows_and_no_labels(spark, model):
    out = t.score(docs(spark, ODD), model).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] < 0.5 for r in out)
    assert t.restored(docs(spark, ODD), model).count() == len(ODD)
    assert t.score(docs(spark, []), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = t.fit(docs(spark, []), none)
    assert all(r["score"] < 1e-9 for r in t.score(docs(spark, ODD), empty).collect())


def test_character_counts_cover_all_rows(spark):
    rows = [(i, "ab a") for i in range(50)] + [(99, "ab " * 200_000)]
    counts = t.count_trigrams(docs(spark, rows)).reshape(t.SIZE, t.SIZE, t.SIZE)
    a, b = t.place_of("a"), t.place_of("b")
    assert counts[0, a, b] == 50 + 200_000
    assert counts[0, a, 0] == 50


def test_drop_keeps_columns(spark):
    df = docs(spark, [(1, "fine"), (None, None)])
    out = t.drop_toxic(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert out.columns == df.columns and out.count() == 2
