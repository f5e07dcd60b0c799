import random
import re

import numpy as np
import pytest
import xxhash

from textdims.llm import simhash
from textdims.llm.components import components

from .helpers import ODD, docs, words


def brute_fp(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall("[^\\x20\\x09-\\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, fps, bits=2):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(rows))]


def test_golay_decoder_is_perfect():
    r = np.random.default_rng(1)
    code = simhash.codeword_index(np.arange(1 << 12) << 11 ^ simhash._syndromes(np.arange(1 << 12) << 11))
    assert (code == np.arange(1 << 12)).all()
    word = (np.arange(1 << 12) << 11) ^ simhash._syndromes(np.arange(1 << 12) << 11)
    for _ in range(20):
        error = sum(1 << int(b) for b in r.choice(23, 3, replace=False))
        assert (simhash.codeword_index(word ^ error) == np.arange(1 << 12)).all()


def test_close_fingerprints_share_a_key_and_keys_are_few():
    r = np.random.default_rng(2)
    a = r.integers(0, 2**64, 400, dtype=np.uint64)
    for bits in (1, 2):
        b = a.copy()
        for i in range(len(b)):
            for k in r.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(k)
        ra, ka, _ = simhash.golay_keys(a)
        rb, kb, _ = simhash.golay_keys(b)
        for i in range(len(a)):
            assert set(ka[ra == i]) & set(kb[rb == i])
            assert len(set(ka[ra == i])) <= 16


def test_odd_rows(spark):
    got = {(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_groups(docs(spark, ODD)).collect()}
    fps = [brute_fp(t) for _, t in ODD]
    assert got == {(d, f, c) for (d, _), f, c in zip(ODD, fps, brute_components(ODD, fps), strict=True)}


@pytest.mark.parametrize("bucket", [64, 1])
def test_links_against_all_pairs(spark, bucket):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        if i % 3 == 0 or not rows:
            rows.append((i, words(rng, rng.choice([0, 1, 2, 3, 60]))))
        else:
            w = rows[rng.randrange(len(rows))][1].split()
            for _ in range(rng.randrange(2)):
                if w:
                    w[rng.randrange(len(w))] = f"x{rng.randrange(5)}"
            rows.append((i, " ".join(w)))
    fps = [brute_fp(t) for _, t in rows]
    want = brute_components(rows, fps)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs(spark, rows), bucket=bucket).collect()}
    assert [got[d] for d, _ in rows] == want
    assert sum(a != d for (d, _), a in zip(rows, want, strict=True)) > 50


@pytest.mark.parametrize("bucket,bits", [(64, 2), (2, 2), (64, 1), (2, 1)])
def test_dense_fingerprints(spark, bucket, bits):
    """Many different fingerprints within a few bits of each other."""
    rng = random.Random(6)
    centre = [rng.getrandbits(64) for _ in range(3)]
    fps = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for c in centre for _ in range(120)})
    rows = [(i, None) for i in range(len(fps))]
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["id"]: r["root"] for r in components(simhash.links(df, bucket, bits)).collect()}
    want = brute_components(rows, fps, bits)
    classes = {}
    for i, f in enumerate(signed):
        classes.setdefault(want[i], set()).add(roots.get(f, f))
    assert all(len(c) == 1 for c in classes.values())
    assert len({c.pop() for c in classes.values()}) == len(set(want))


def test_components_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (2, 1)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    rng = random.Random(7)
    hot = words(rng, 80)
    df = docs(spark, [(i, hot if i % 3 == 0 else words(rng, 60)) for i in range(90)])
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i in range(90) if i % 3 or i == 0]
    assert simhash.drop_near_copies(docs(spark, [])).count() == 0


def test_one_of_repeated_rows_stays(spark):
    rng = random.Random(8)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    twice = [(1, a), (2, a), (None, b), (None, c), (5, d)]
    df = docs(spark, twice * 2 + [(1, a.upper()), (5, d.upper()), (5, c + " more " + b)])
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    # texts that share an id are told apart, components without ids too
    assert sorted(((r["doc_id"], r["text"].lower()) for r in out.collect()), key=str) == sorted([(1, a), (None, b), (None, c), (5, d), (5, c + " more " + b)], key=str)
