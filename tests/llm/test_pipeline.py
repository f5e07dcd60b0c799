"""The pipeline against its parts done by brute force on the driver."""

import random

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textdims.llm import toxicity
from textdims.llm.common import table

from ..conftest import SF_SMALL
from .helpers import ODD, docs, words
from .test_decontaminate import brute as contamination
from .test_exact_dedup import lower
from .test_simhash import brute_components, brute_fp


def left_by_brute_force(rows, toxic, items):
    """Rows (id, text) that the first four stages leave; ``toxic``: ids that go."""
    rows = [r for r in rows if r[0] not in toxic]
    last = {}
    for i, t in rows:
        last[lower(t)] = max(last.get(lower(t), i), i)
    rows = [(i, t) for i, t in rows if last[lower(t)] == i]
    component = brute_components(rows, [brute_fp(t) for _, t in rows])
    rows = [r for r, c in zip(rows, component, strict=True) if c == r[0]]
    hit = {r[0] for r in contamination(rows, items) if r[5]}
    return [r for r in rows if r[0] not in hit]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "encoding"]


def test_run_on_the_small_tables(spark):
    d, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    model = toxicity.fit(d, labels, keep=~toxicity.held_out())
    toxic = {r["doc_id"] for r in toxicity.score(d, model).filter(F.col("score") >= 0.5).collect()}
    rows = [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    want = left_by_brute_force(rows, toxic, items)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in got} == {i: t.encode(x, add_special_tokens=False).ids for i, x in want}
    assert len(got) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    rng = random.Random(1)
    item = words(rng, 30)
    rows = [*ODD, (50, words(rng, 20) + " " + item), (51, words(rng, 40)), (52, words(rng, 40)), (53, None)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table_rows in (rows, []):
        df = docs(spark, table_rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, str(tmp_path))
            assert out.columns == df.columns, name
            df = spark.createDataFrame(out.collect(), out.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path))
        ids = [r["doc_id"] for r in last.collect()]
        assert (51 in ids, 52 in ids, 50 in ids) == ((True, True, False) if table_rows else (False,) * 3)
