import random
import re
from fractions import Fraction
from math import ceil

import numpy as np
import pytest

from textdims.llm import license_scan as s

from .helpers import ODD, docs, words


def tokens(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, templates, phrases):
    """(words, places, labels of templates, score) over every block of every template."""
    w = tokens(text)
    places = sorted((p, label) for phrase, label in phrases.items() for n in [len(tokens(phrase))] for p in range(len(w) - n + 1) if w[p : p + n] == tokens(phrase))
    found, score = set(), 0.0
    for label, t, share in templates:
        tw = tokens(t)
        asked = ceil(share * len(set(tw)))
        for a in range(max(1, len(w) - len(tw) + 1)):
            n = len(set(w[a : a + len(tw)]) & set(tw))
            if n >= asked:
                found.add(label)
                score = max(score, n / len(set(tw)))
    labels = {label for _, label in places}
    at = [p for p, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | found)), 1.0 if at else score)


def check(spark, rows, templates=s.TEMPLATES, phrases=s.PHRASES):
    got = s.label_digest(s.find_licenses(docs(spark, rows), templates, phrases)).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted([(i, *brute(t, templates, phrases)) for i, t in rows], key=str)


def planted(seed):
    rng = random.Random(seed)
    rows = list(ODD)
    for i in range(100, 220):
        text = words(rng, rng.randrange(80)).split()
        for _ in range(rng.randrange(3)):
            piece = rng.choice([t for _, t, _ in s.TEMPLATES] + list(s.PHRASES) + ["CC  BY"]).split()
            lost = rng.random() * 0.4
            piece = [w for w in piece if rng.random() > lost] if rng.random() < 0.7 else piece
            at = rng.randrange(len(text) + 1)
            text[at:at] = piece
        rows.append((i, rng.choice([" ", "\n# ", "-"]).join(text).swapcase() if rng.random() < 0.3 else " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, planted(seed))


def test_common_words_and_repeats(spark):
    """Templates of repeated, very common and shared words."""
    rng = random.Random(3)
    templates = tuple((f"t{k}", words(rng, n, 9), Fraction(share, 10)) for k, (n, share) in enumerate([(1, 10), (3, 5), (6, 7), (10, 8), (25, 9), (40, 8), (12, 1)]))
    check(spark, [(i, words(rng, rng.randrange(70), 12)) for i in range(120)], templates, {"w1 w2": "one", "w1 w1": "two", "w3": "three"})


def test_blocks_cover_all_matching_windows():
    rng = random.Random(4)
    for _ in range(300):
        template = ("x", words(rng, rng.randrange(1, 12), 8), Fraction(rng.randrange(1, 11), 10))
        scanner = s.Scanner([template], {})
        scanner.order(np.array([rng.randrange(5) for _ in scanner.number], np.int64))
        w = words(rng, rng.randrange(60), 14).split()
        tw = template[1].split()
        want = set()
        for a in range(max(1, len(w) - len(tw) + 1)):
            if len(set(w[a : a + len(tw)]) & set(tw)) >= ceil(template[2] * len(set(tw))):
                want |= set(range(a, min(a + len(tw), len(w))))
        got = [k for _, a, b, _ in scanner.blocks(scanner.ids([x.encode() for x in w])) for k in range(a, b)]
        assert sorted(got) == sorted(want)


def test_no_templates_empty_table_and_refusals(spark):
    check(spark, ODD + [(9, "All rights  reserved. all RIGHTS reserved")], ())
    assert s.find_licenses(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        s.Scanner([("x", "--", Fraction(1))], {})
    with pytest.raises(ValueError):
        s.Scanner([("x", "w " * s.TEMPLATE_BYTES, Fraction(1))], {})
