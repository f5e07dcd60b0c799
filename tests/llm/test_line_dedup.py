import random

import pytest

from textdims.llm import line_dedup

from .helpers import ODD, docs


def brute(rows, size=3):
    lines = [(t or "").split("\n") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0, rows[r][1] or ""))
    first = {}
    for r in order:
        for p in range(len(lines[r]) - size + 1):
            first.setdefault(tuple(lines[r][p : p + size]), (rows[r], p))
    out = []
    for r, (i, t) in enumerate(rows):
        gone = {q for p in range(len(lines[r]) - size + 1) if first[tuple(lines[r][p : p + size])] != (rows[r], p) for q in range(p, p + size)}
        out.append((i, len(lines[r]), len(gone), "\n".join(x for k, x in enumerate(lines[r]) if k not in gone)))
    return sorted(out, key=str)


def check(spark, rows):
    assert sorted([tuple(r) for r in line_dedup.dedup_lines(docs(spark, rows)).collect()], key=str) == brute(rows)


def test_odd_rows(spark):
    check(spark, [r for r in ODD if r[0] is not None])
    assert line_dedup.dedup_lines(docs(spark, ODD)).count() == len(ODD)
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = [f"shared {k}" for k in range(6)]
    rows = []
    for i in range(120):
        x = [f"l{rng.randrange(4 if i % 4 == 0 else 400)}" for _ in range(rng.randrange(12))]
        if rng.random() < 0.4:
            at = rng.randrange(len(x) + 1)
            x[at:at] = passage[rng.randrange(3) :]
        rows.append((i, "\n".join(x)))
    check(spark, rows)


def test_one_passage_in_a_third_of_the_rows(spark):
    rows = [(i, f"own {i}\na\nb\nc\nd\nend {i}" if i % 3 == 0 else f"x {i}\ny {i}\nz {i}") for i in range(300)]
    check(spark, rows)
