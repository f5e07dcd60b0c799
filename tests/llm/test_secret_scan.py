import base64
import hashlib
import random
import re

from textdims.llm import secret_scan as s
from textdims.llm.common import table
from textdims.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import ODD, docs

BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def brute(text):
    return [(k, m.start(), m.end()) for _, n, k, m in sorted((m.start(), n, k, m) for n, (k, rx, ok) in enumerate(BASE) for m in rx.finditer(text or "") if ok(m))] if text else []


def spans(spark, rows):
    return [(r["doc_id"], [tuple(x) for x in r["spans"]]) for r in s.find_secrets(docs(spark, rows)).collect()]


def test_base_spans(spark):
    rng = random.Random(11)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "apikey", "api-key", '"', "'", " ", "  ", ":", "=", "==", "abc", "abcdef", "AKIA", "AKIA" + "Z9" * 9, "deadbeef" * 3, "0a1", "é", "🙂", "\n", "ſecret", "toKen", "x.y/z+q-"]
    rows = ODD + [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(100, 700)]
    got = spans(spark, rows)
    assert sorted(((d, [x for x in sp if x[0] != "random"]) for d, sp in got), key=str) == sorted(((d, brute(t)) for d, t in rows), key=str)


def test_random_tokens_found_and_plain_ones_left():
    rng = random.Random(12)
    hits = 0
    for _ in range(100):
        token = base64.b64encode(rng.randbytes(30)).decode()
        hits += any(k == 3 for _, k, _ in s.scan(f"see {token} there"))
    assert hits >= 90
    plain = "the_quick_brown_fox_jumps_over configurationManagerFactoryBean 2024-01-15-2024-02-15-2024 internationalizationandlocalization /usr/local/share/applications/mime ------------------------------ aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa 12345678901234567890123456789 GNU_GENERAL_PUBLIC_LICENSE_VERSION"
    assert [x for x in s.scan(plain) if x[1] == 3] == []


def test_tests_reject_what_they_should():
    import numpy as np

    r = np.random.default_rng(13)
    even = [s.chi_squared(r.integers(0, 16, 64), 16) for _ in range(500)]
    assert 0.01 < np.mean([p < 0.05 for p in even]) < 0.12
    assert s.chi_squared(np.zeros(40, int), 16) < 1e-6
    assert s.runs(np.arange(40) % 2 * 15, 16) < 1e-4
    assert s.serial(np.repeat(np.arange(16), 4), 16) < 1e-4


def test_false_discoveries_weigh_lengths():
    assert s.discoveries([]) == []
    assert s.discoveries([(1e-9, 20), (0.5, 20), (1.0, 200)]) == [True, False, False]
    assert s.discoveries([(8e-4, 20), (1.0, 500)]) == [False, False]


def test_query_on_whole_table(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_secret_scan"](spark, SF_SMALL).collect()}
    rows = table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        want, g = brute(r["text"]), got[r["doc_id"]]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert g["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [g[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[0] == k for x in want) for k in ("assign", "access", "hex")]
        assert [x for x in g["spans"].split(",") if x and not x.startswith("random")] == [x for x in text.split(",") if x]


def test_empty_table(spark):
    assert s.find_secrets(docs(spark, [])).count() == 0


def test_secrets_beside_foreign_signs_and_base_spans():
    rng = random.Random(14)
    letters = s.ENCODINGS["base62"]
    hits = {"path": 0, "id": 0, "hook": 0, "short": 0}
    for _ in range(100):
        key, short, digest = "".join(rng.choices(letters, k=32)), "".join(rng.choices(letters, k=17)), "".join(rng.choices("0123456789abcdef", k=32))
        for name, text, secret in (("path", f"get /api-v1/{key} now", key), ("id", f"key_id/{key}", key), ("hook", f"/hook/{digest}/{key}", key), ("short", f"see {short} there", short)):
            at = text.index(secret)
            found = s.scan(text)
            hits[name] += any(k == 3 and a <= at and at + len(secret) <= b for a, k, b in found)
            random_ = [(a, b) for a, k, b in found if k == 3]
            assert all(b <= c for (_, b), (c, _) in zip(random_, random_[1:]))
    assert min(hits.values()) >= 90, hits
    assert [x for x in s.scan("/usr-local/share_of/applications-and/mime_types key_id/configuration-manager/factoryBean") if x[1] == 3] == []
