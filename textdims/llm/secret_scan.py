"""Secret scan: fixed patterns, and a battery of randomness tests for other tokens.

Base patterns (kinds assign, access, hex) mark their spans whatever the tests say.

Battery: outside the base spans, the text is cut into the maximal runs of each
encoding's alphabet.  Every run of at least ``SHORTEST`` characters (below that no
outcome of the runs test is rare enough to reject) is tried under the smallest
alphabets that hold it (decimal numbers are no secrets).  Under the encoding, as if
the characters were drawn evenly and independently, it must pass a chi-squared test of the alphabet's
uniformity, a runs test above and below the alphabet's middle, and a test of serial
correlation.  Then the token is held against ordinary structured text: a fixed
model of letter, digit and sign classes that follow one another.  The ratio of the two
likelihoods is an e-value for "structured", so its inverse bounds the chance
that a structured token looks this random; it falls with the length, so long tokens
can show more than short ones.  Within a document the Benjamini-Hochberg
procedure, with weights by length, keeps the false discoveries at ``RATE``.  Runs of
different encodings overlap; discoveries that do are one span.

Spans are in code points, end exclusive.  Defined cases: a null text is empty;
an empty text has no spans; null ids and repeated rows are scanned like any other;
columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_arrow

# The base patterns and their least lengths, in the order of ties.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Error rates of the battery, and the least length at which each of its tests can reject: n characters on
#: one side of the middle have a chance of 2 ** (1 - n); the other two tests reject shorter ones.
ALPHA, RATE = 1e-4, 1e-3
SHORTEST = 1 + math.ceil(-math.log2(ALPHA))
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}")
_PADDING = re.compile("={0,2}")
# the same runs as HEX with their least length, found without stopping at each short one
_LONG_HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets in the order of their digits.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_RUNS = [re.compile(rf"[{re.escape(letters)}]{{{SHORTEST},}}") for letters in ENCODINGS.values()]


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_LEAST:
            yield m.start(), 0, m.end()
    for m in ACCESS.finditer(text):
        if len(m[0]) >= ACCESS_LEAST:
            yield m.start(), 1, m.end()
    for m in _LONG_HEX.finditer(text):
        yield m.start(), 2, m.end()


# ---------------------------------------------------------------- battery


def _normal_tail(z: float) -> float:
    """Two-sided."""
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared(x: np.ndarray, k: int) -> float:
    """Chance of letter counts at least this uneven (Wilson-Hilferty)."""
    n, df = len(x), k - 1
    stat = float(((np.bincount(x, minlength=k) - n / k) ** 2).sum() * k / n)
    z = ((stat / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs(x: np.ndarray, k: int) -> float:
    """Wald-Wolfowitz test of the runs above and below the alphabet's middle."""
    above = x >= k // 2
    a = int(above.sum())
    b = len(x) - a
    if not a or not b:
        return 2.0 ** (1 - len(x))
    mean = 1 + 2 * a * b / (a + b)
    var = (mean - 1) * (mean - 2) / max(1, a + b - 1)
    return _normal_tail((1 + int((above[1:] != above[:-1]).sum()) - mean) / math.sqrt(max(var, 1e-9)))


def serial(x: np.ndarray, k: int) -> float:
    """Lag-one correlation of the digits."""
    c = x - (k - 1) / 2
    var = (k * k - 1) / 12
    return _normal_tail(float((c[1:] * c[:-1]).sum()) / (var * math.sqrt(len(x) - 1)))


#: Fixed model of structured tokens: chance of the class after a class, and of a character in its class.
_CLASS = {**dict.fromkeys(_LOWER, 0), **dict.fromkeys(_UPPER, 1), **dict.fromkeys(_DIGITS, 2), **dict.fromkeys("+/-_=", 3)}
_NEXT = np.log(np.array([[0.86, 0.04, 0.03, 0.07], [0.40, 0.48, 0.04, 0.08], [0.05, 0.05, 0.80, 0.10], [0.45, 0.20, 0.30, 0.05]]))
_START = math.log(0.25)
#: Percent of English letters, e to z; the rest of the model's languages are close enough for a bound.
_FREQUENT = {"e": 12.0, "t": 9.1, "a": 8.1, "o": 7.7, "i": 7.3, "n": 7.0, "s": 6.3, "r": 6.0, "h": 5.9, "d": 4.3, "l": 4.0, "u": 2.9, "c": 2.7, "m": 2.6, "f": 2.3, "y": 2.1, "w": 2.1, "g": 2.0, "p": 1.8, "b": 1.5, "v": 1.1, "k": 0.7, "x": 0.2, "q": 0.1, "j": 0.1, "z": 0.1}
_WITHIN = {c: math.log((p + 0.1) / 102.6) for c, p in _FREQUENT.items()}
_WITHIN |= {c.upper(): v for c, v in _WITHIN.items()} | dict.fromkeys(_DIGITS, math.log(0.1)) | dict.fromkeys("+/-_=", math.log(0.2))


def structured_log_likelihood(token: str) -> float:
    classes = np.array([_CLASS[c] for c in token])
    return _START + float(_NEXT[classes[:-1], classes[1:]].sum()) + sum(_WITHIN[c] for c in token)


def inferred(token: str) -> list[str]:
    """Encodings whose alphabet holds the token and that fit it: the smallest of their kind."""
    held = set(token)
    fits = [name for name, letters in ENCODINGS.items() if held <= set(letters)]
    least = min((len(ENCODINGS[f]) for f in fits), default=0)
    return [f for f in fits if len(ENCODINGS[f]) == least]


def randomness(token: str) -> float:
    """Bound on the chance that a structured token looks as random as this one; 1 if a test of the battery fails."""
    bare = token.rstrip("=")
    best = 1.0
    if bare.isdigit():
        return best
    for name in inferred(bare):
        letters = ENCODINGS[name]
        digit = {c: i for i, c in enumerate(letters)}
        x, k = np.array([digit[c] for c in bare]), len(letters)
        if min(chi_squared(x, k), runs(x, k), serial(x, k)) < ALPHA:
            continue
        log_e = -len(bare) * math.log(k) - structured_log_likelihood(bare)
        best = min(best, math.exp(-max(0.0, min(700.0, log_e))))
    return best


def discoveries(tokens: list[tuple[float, int]], rate: float = RATE) -> list[bool]:
    """Which of the (bound, length) survive Benjamini-Hochberg with weights in proportion to the length."""
    if not tokens:
        return []
    p = np.array([t[0] for t in tokens])
    weight = np.array([t[1] for t in tokens], float)
    q = p * weight.mean() / weight
    order = np.argsort(q, kind="stable")
    ok = np.flatnonzero(q[order] <= rate * np.arange(1, len(q) + 1) / len(q))
    out = np.zeros(len(q), bool)
    if len(ok):
        out[order[: ok[-1] + 1]] = True
    return out.tolist()


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the maximal runs of each encoding outside the base spans, with their padding."""
    found, at = set(), 0
    for a, b in [*sorted((a, b) for a, _, b in base), (len(text), len(text))]:
        for m in _CANDIDATE.finditer(text, at, max(at, a)):
            for run in _RUNS:
                found.update((x.start(), _PADDING.match(text, x.end(), a).end()) for x in run.finditer(text, *m.span()))
        at = max(at, b)
    return sorted(found)


def random_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    found = [(a, b, randomness(text[a:b])) for a, b in candidates(text, base)]
    spans: list[list[int]] = []
    for (a, b, _), ok in zip(found, discoveries([(p, b - a) for a, b, p in found]), strict=True):
        if ok and spans and a < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        elif ok:
            spans.append([a, b])
    for a, b in spans:
        yield a, 3, b


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, in order."""
    base = list(base_spans(text))
    return sorted([*base, *random_spans(text, base)])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end), by start and then kind."""

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def span_digest(found: DataFrame) -> DataFrame:
    """Counts, digest and joined spans of ``find_secrets``."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def many(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", *map(many, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
