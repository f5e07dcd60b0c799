import hashlib
import random
import re

import numpy as np
import pytest

from textdims.llm import decontaminate as d

from .helpers import ODD, docs, words


def tokens(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items):
    wins = {}
    for i, t in items:
        w = tokens(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[a : a + 10]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, of = tokens(t), set(), set()
        for n in {len(x) for x in wins}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in wins:
                    hit |= set(range(a, a + n))
                    of |= wins[tuple(w[a : a + n])]
        out.append((i, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")


def check(spark, rows, items, **kw):
    got = d.hit_counts(d.find_windows(docs(spark, rows), bench(spark, items), **kw)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows, items)


def planted(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.choice([0, 1, 2, 3, 9, 10, 11, 25]), 12)) for i in range(30)] + [(30, None), (31, "—!—"), (3, words(rng, 12, 12)), (40, "É été " * 6)]
    rows = list(ODD)
    for i in range(100, 220):
        w = words(rng, rng.randrange(60), 12).split()
        if rng.random() < 0.5:
            at = rng.randrange(len(w) + 1)
            w[at:at] = (rng.choice(items)[1] or "").upper().split()
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, *planted(seed))


def test_several_blocks_give_the_same(spark):
    check(spark, *planted(3), block_bytes=200)


def test_long_items_are_cut_into_runs(spark):
    """Items over a block: their windows are all found, also those across the cuts."""
    rng = random.Random(8)
    long = words(rng, 400, 300)
    w = long.split()
    rows = [(i, " ".join(["x", *w[a : a + n], "y"])) for i, (a, n) in enumerate([(0, 10), (17, 9), (23, 10), (24, 15), (50, 200), (389, 11), (390, 10), (391, 9)])]
    check(spark, rows, [(1, long), (2, long[:900]), (3, "short one"), (4, "é" * 500)], block_bytes=150)
    for size in (40, 150, 10**6):
        runs = [d.words_of(r) for r in d.item_runs(long.encode(), size)]
        assert {x for r in runs for x in d.windows_of(r)} == set(d.windows_of(d.words_of(long.encode())))


def test_very_many_different_words_in_one_item():
    """More different words than one block can number: the runs of the item can all be built."""
    text = " ".join(f"{k:x}" for k in range(2_200_000)).encode()
    sizes = [len(r) for r in d.item_runs(text, d.BLOCK_BYTES)]
    assert len(sizes) > 1 and max(sizes) <= d.BLOCK_BYTES
    d.ItemBlock([("1", next(d.item_runs(text, d.BLOCK_BYTES)))])


def test_one_passage_of_many_items():
    """20,000 items with one passage: each of its windows is kept once."""
    passage = " ".join(f"p{k}" for k in range(20))
    block = d.ItemBlock([(str(k), passage.encode()) for k in range(20_000)])
    assert len(block.start) == 11
    block.choose_prefixes(np.zeros(block.known, np.int64))
    document = ("filler words " * 300 + passage + " and more").encode()
    at, items = block.hits(d._ids(d.words_of(document), block.number))
    assert len(at) == 20 and len(items) == 20_000


def test_empty_sides(spark):
    check(spark, ODD, [])
    check(spark, ODD, [(1, None), (2, "!!")])
    assert d.find_windows(docs(spark, []), bench(spark, [(1, "a b c")])).count() == 0


def test_very_common_words(spark):
    """Items of one repeated word: the prefix is in every document."""
    check(spark, [(i, "the " * (5 + i % 20)) for i in range(200)], [(1, "the " * 10), (2, "the " * 14), (3, "the the end " * 5)])


def test_drop_keeps_clean_documents(spark):
    df = docs(spark, [(1, "one two three four"), (2, "clean text"), (2, "two three"), (None, None), (2, "clean text")])
    out = d.drop_contaminated(df, bench(spark, [(1, "Two, three!")]))
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "2", "None"]
