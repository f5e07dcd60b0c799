import zlib

import numpy as np

from textdims.llm import quality as q
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from .helpers import ODD, docs

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert len(got) == table(spark, SF, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for d, r in got.items())
    held = [d for d in labels if got[d]["held_out"]]
    assert np.mean([got[d]["predicted"] == labels[d] for d in held]) > 0.95
    assert np.mean([got[d]["predicted"] for d in held if labels[d]]) > 0.97


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.fit(docs(spark, ODD), none)
    assert [r["score"] for r in q.score(docs(spark, ODD), model).collect()] == [0.5] * len(ODD)
    trained = q.Model(q.train([b"good text here", b"%%%%%%%%%%%%%%"] * 8, np.array([1.0, 0.0] * 8), 3, 1), 0.0)
    out = q.score(docs(spark, ODD), trained).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    assert q.score(docs(spark, []), trained).count() == 0


def test_gradients():
    r = np.random.default_rng(3)
    p = q.start(1)
    data = r.integers(32, 127, 700, dtype=np.uint8)

    def loss(p):
        values = q.convolve(data, np.einsum("be,kef->kbf", p["embed"], p["filter"]))
        z = q.forward(p, q.chunk_maxima(values), 1.0)[0]
        return np.logaddexp(0, z) - z

    g, gt = {k: np.zeros_like(v) for k, v in p.items()}, np.zeros((q.WIDTH, 256, q.FILTERS))
    q.gradients(p, np.einsum("be,kef->kbf", p["embed"], p["filter"]), data, 1.0, 1.0, g, gt)
    g["embed"], g["filter"] = np.einsum("kbf,kef->be", gt, p["filter"]), np.einsum("kbf,be->kef", gt, p["embed"])
    for k in p:
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in p[k].shape)
            up, down = ({**p, k: p[k].copy()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - g[k][at]) < 1e-3


def test_slices_cover_the_whole_document():
    tables = q.byte_tables(q.start(2))
    r = np.random.default_rng(4)
    before, q._SLICE = q._SLICE, 1024
    try:
        for n in (0, 1, 5, 255, 256, 261, 262, 1000, 2048, 2049, 2300, 5000, 10_241):
            data = r.integers(0, 256, n, dtype=np.uint8)
            values = q.convolve(data, tables)
            want = np.stack([values[s : s + q.CHUNK].max(0) for s in q.chunk_starts(len(values))])
            assert np.array_equal(q.all_maxima(data, tables), want)
    finally:
        q._SLICE = before
