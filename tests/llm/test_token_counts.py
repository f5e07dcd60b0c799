import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textdims.llm import token_counts
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import ODD, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def check(spark, library, rows, **kw):
    got = sorted([tuple(r) for r in token_counts.count_tokens(docs(spark, rows), PATH, **kw).collect()], key=str)
    assert got == sorted([(i, len((t or "").encode()), library(t)) for i, t in rows], key=str)


def test_odd_rows(spark, library):
    check(spark, library, ODD)
    check(spark, library, [])


def test_spaces_specials_and_contractions(spark, library):
    rng = random.Random(8)
    parts = [" ", "  ", "\n", " \n ", "\t", " ", " ", "\x1c", "it's", "they'll", "12", "a", "<|endoftext|>", "é", "漢字", "🙂", "...", "x" * 300, "　", "é"]
    check(spark, library, [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(300)])


def test_table_never_changes_counts(spark, library):
    rows = [(i, "the same few words again " * 50) for i in range(20)]
    check(spark, library, rows, table_size=1)
    check(spark, library, rows)


def test_query_on_whole_table(spark, library):
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op1_token_counts"](spark, SF_SMALL).collect()}
    want = {r["doc_id"]: (len(r["text"].encode()), n := library(r["text"]), n > 1024) for r in table(spark, SF_SMALL, "documents").collect()}
    assert got == want
