import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textdims.llm import source_divergence as s


def terms(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, least):
    rows = [(lang or "", source or "", terms(text)) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, ts in own for t in set(ts))
        kept = {t for t, n in df.items() if n >= least}
        count = {g: Counter(t for _, x, ts in own if x == g for t in ts if t in kept) for g in {r[1] for r in own}}
        whole = sum(count.values(), Counter())
        v = len(kept)

        def shares(c):
            total = sum(c.values())
            return {t: 1 + (10**9 * (c[t] + 2)) // (total + 2 * v) for t in kept}

        p = {g: shares(c) for g, c in count.items()}
        q = shares(whole)
        for g in p:
            pairs = [(h, sum((p[g][t] - p[h][t]) ** 2 // (p[g][t] + p[h][t]) for t in kept)) for h in p if h != g]
            over = [(t, (p[g][t] - q[t]) ** 2 // (p[g][t] + q[t])) for t in kept if count[g][t] > 0 and p[g][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", over, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, g, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("n", "docs", "p", "p0", "set", "sets", "term", "block", "doc_id"):
        df = df.withColumn(name, F.lit("x"))
    return df


def made(seed, n, kinds=60, sources=7):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß文") for _ in range(rng.randrange(1, 5))) for _ in range(kinds)]
    rows = [(None, None, None), ("en", "empty", ""), ("en", "empty", "12 34 --"), ("xx", "one", "rare words"), ("xx", "two", "other words"), ("en", None, "@Ab[cd`ef{gh" * 3)]
    for _ in range(n):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(kinds)], k=rng.randrange(0, 40))
        rows.append((rng.choice(["en", "en", "de", None]), f"s{rng.randrange(sources)}", rng.choice([" ", ", ", "9"]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return rows + rows[10:30]


@pytest.mark.parametrize("seed,block", [(1, 8192), (2, 5), (3, 70)])
def test_against_brute_force(spark, seed, block):
    rows = made(seed, 150)
    got = s.audit(table(spark, rows), least_docs=4, block=block).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4)


def test_many_sources_in_several_sets(spark, monkeypatch):
    monkeypatch.setattr(s, "SET", 3)
    monkeypatch.setattr(s, "COUNTED", 20)
    rows = made(4, 200, sources=17)
    got = s.audit(table(spark, rows), least_docs=3, block=16).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)


def test_cells_in_small_steps():
    rng = random.Random(5)
    rows = []
    for source in "ab":
        place = sorted(rng.sample(range(300), 200))
        level = [rng.randrange(1, 9) for _ in place]
        words: dict = {}
        for k, n in zip(place, level, strict=True):
            words[n, k >> 6] = words.get((n, k >> 6), 0) | 1 << (k & 63)
        keys = sorted(words)
        p = sorted({n for n, _ in keys})
        signed = [words[k] - (1 << 64 if words[k] >= 1 << 63 else 0) for k in keys]
        rows.append(dict(source=source, set=0, p0=1, p=p, ends=[sum(n <= x for n, _ in keys) for x in p], places=[w for _, w in keys], words=signed, of=dict(zip(place, level, strict=True))))
    g, h = (s.Levels(r, 5) for r in rows)
    want = Counter((rows[0]["of"][k], rows[1]["of"][k]) for k in rows[0]["of"] if k in rows[1]["of"])
    for room in (1, 10, 1 << 20):
        got = Counter()
        for c, d, n in g.joint(h, room):
            got.update({(int(g.p[a]), int(h.p[b])): int(x) for a, b, x in zip(c, d, n, strict=True)})
        assert got == want


def test_exact_shares_of_very_large_counts(spark):
    rows = [(9_300_000_000, 10**15, 7), (2**62, 2**62, 10**6), (0, 0, 1)]
    got = spark.createDataFrame(rows, "n long, total long, kept long").select(s.share("n", "total", "kept").alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * (n + 2) // (t + 2 * k) for n, t, k in rows]


def test_empty_table(spark):
    assert s.audit(table(spark, [])).count() == 0
