import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textdims.llm import bpe
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import ODD, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)

    def both(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return ids, t.decode(ids, skip_special_tokens=False)

    return both


def check(spark, library, rows):
    got = bpe.decode(bpe.encode(docs(spark, rows), PATH), PATH).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(i, *library(t)) for i, t in rows], key=str)
    assert sorted(map(str, bpe.encode_and_decode(docs(spark, rows), PATH).collect())) == sorted(map(str, got))


def test_odd_rows(spark, library):
    check(spark, library, ODD)
    check(spark, library, [])


def test_mixed_texts(spark, library):
    rng = random.Random(9)
    parts = [" ", "\n", " ", " ", "\x1c", "\x85", "᠎", "​", "It's", "WE'LL", "12", "a", "<|endoftext|>", "<|startoftext|>", "</w>", "É", "é", "ΣΑΣ", "İ", "漢字", "🙂", "...", "ſ", "K"]
    check(spark, library, [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(300)])


def test_random_words_are_merged_exactly(library):
    v = bpe.Vocabulary(bpe.read_tokenizer(PATH))
    rng = random.Random(10)
    for letters in ("ab", "aeinst", "abcdefghijklmnopqrstuvwxyz", "éßñaei", "!?.-"):
        for _ in range(1500):
            w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 24)))
            assert list(v.chunk(w)) == library(w)[0], w


def test_long_word_is_linear(library):
    v = bpe.Vocabulary(bpe.read_tokenizer(PATH))
    for w in ("a" * 20_000, "ab" * 10_000, "thethe" * 3_000):
        assert list(v.chunk(w)) == library(w)[0]


def test_query_on_whole_table(spark, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_bpe"](spark, SF_SMALL).collect()}
    for r in table(spark, SF_SMALL, "documents").collect():
        ids, text = library(r["text"])
        assert got[r["doc_id"]] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
