import hashlib
import random
from collections import defaultdict

from textdims.llm import exact_dedup

from .helpers import ODD, docs, words


def lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **kw):
    got = exact_dedup.dedup_groups(docs(spark, rows), **kw).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_odd_rows(spark):
    check(spark, ODD)


def test_common_beginnings_and_small_digits(spark):
    rng = random.Random(3)
    base = [words(rng, 40) for _ in range(6)]
    rows = [(i, base[rng.randrange(6)] + " tail" * rng.randrange(3) + rng.choice(["", "A", "a", "É", "é"])) for i in range(300)]
    check(spark, rows)
    check(spark, rows, digits=(1, 3, 16))


def test_a_third_of_all_rows_equal(spark):
    rng = random.Random(4)
    hot = words(rng, 500)
    check(spark, [(i, hot.upper() if i % 3 == 0 else words(rng, 20)) for i in range(600)])


def test_empty_table(spark):
    assert exact_dedup.dedup_groups(docs(spark, [])).count() == 0
    assert exact_dedup.drop_copies(docs(spark, [])).count() == 0


def test_drop_copies_keeps_columns_and_largest(spark):
    shared = docs(spark, [(1, "copy"), (1, "its own text"), (3, "copy")])
    assert sorted((r["doc_id"], r["text"]) for r in exact_dedup.drop_copies(shared).collect()) == [(1, "its own text"), (3, "copy")]
    df = docs(spark, [(1, "Same"), (9, "same"), (5, "SAME"), (2, "other"), (None, "same"), (None, None)])
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "9", "None"]


def test_drop_copies_leaves_one_of_repeated_rows(spark):
    twice = [(1, "own"), (3, "copy"), (2, "COPY"), (None, "no id"), (None, "NO id"), (None, None), (None, "")]
    df = docs(spark, twice * 2 + [(4, "once"), (3, "another of that id")])
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], lower(r["text"])) for r in out.collect()), key=str) == sorted([(1, "own"), (3, "copy"), (None, "no id"), (None, ""), (4, "once"), (3, "another of that id")], key=str)
