"""Toxicity by noisy-channel deobfuscation.

1. A character trigram model is counted over *all* documents: each task adds up
   one array over the small alphabet and sends its cells, so the driver gets at
   most alphabet^3 sums.
2. Tokens that may be disguised (look-alike characters inside, letters drawn
   out, single letters spaced or separated) span a lattice: each look-alike may
   be one of its letters or itself, a repeated letter may go, a separator
   between single letters may go.  Viterbi decoding picks the path that the
   channel and the character model find likeliest.  All other tokens have one
   path and stay.
3. The restored text is scored by a logistic regression on words and their first
   letters.  It learns from a bounded sample of labelled rows
   (``Sample``); candidate features are counted over the sample on the executors,
   near copies counting once, and kept when their excess in toxic rows is
   significant.

Defined cases: a null text is empty; a text without known features gets the
same low score as an empty one; without labelled rows of both classes every score
is the share of toxic rows (0 if there are none); null ids and repeated rows are
scored like any other; a repeated label takes the larger value; columns other
than id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, id_and_text, map_arrow, text_key, unit_hash, without

# ---------------------------------------------------------------- character model

#: Fixed alphabet: 0 is every non-letter, then a-z, the Latin-1 small letters, and one place for all other letters.
_LATIN = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]
ALPHABET = [chr(0), *(chr(c) for c in range(97, 123)), *_LATIN, chr(0xFFFF)]
SIZE = len(ALPHABET)
OTHER = SIZE - 1
_PLACE = {c: i for i, c in enumerate(ALPHABET[:OTHER])}
_TABLE_END = 0x3000


def place_of(ch: str) -> int:
    low = ch.lower()
    return _PLACE.get(low, OTHER if ch.isalpha() else 0)


_CODES = np.array([place_of(chr(c)) for c in range(_TABLE_END)], np.int64)


def trigram_cells(text: str) -> np.ndarray:
    """Cell of each character with the two before it in its word; a run of non-letters is one boundary."""
    points = np.frombuffer((" " + text + " ").encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(points < _TABLE_END, _CODES[np.minimum(points, _TABLE_END - 1)], OTHER)
    codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]
    before = codes[:-1]
    two_before = np.where(before == 0, 0, np.r_[0, codes[:-2]])
    return (two_before * SIZE + before) * SIZE + codes[1:]


def _pieces(texts: list[str], size: int = 1 << 18):
    """The texts joined or cut at spaces to pieces of about ``size`` characters."""
    held, n = [], 0
    for text in texts:
        at = 0
        while len(text) - at > size and (end := text.find(" ", at + size)) > 0:
            yield text[at:end]
            at = end
        held.append(text[at:] if at else text)
        n += len(held[-1])
        if n > size:
            yield "\n".join(held)
            held, n = [], 0
    yield "\n".join(held)


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over every document."""

    def run(batches):
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for piece in _pieces(batch.column("text").to_pylist()):
                total += np.bincount(trigram_cells(piece), minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counts = np.zeros(SIZE**3, np.int64)
    for r in map_arrow(docs.select("text"), run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["cell"]] = r["n"]
    return counts


def log_model(counts: np.ndarray, weight: float = 8.0) -> list[float]:
    """Flat table of log P(c | a, b), each order backed off to the shorter one with ``weight`` pseudo-counts."""
    c3 = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + SIZE)
    p2 = (c2 + weight * p1[None, :]) / (c2.sum(1, keepdims=True) + weight)
    p3 = (c3 + weight * p2[None, :, :]) / (c3.sum(2, keepdims=True) + weight)
    return np.log(p3).ravel().tolist()


# ---------------------------------------------------------------- channel

#: Letters that a look-alike may stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou"}
SEPARATORS = " .-_*~'"
#: Log costs of the channel: a look-alike for a letter, a look-alike kept, a repeated letter dropped, a separator dropped.
SWAP, KEEP, DROP_REPEAT, DROP_SEPARATOR = -1.0, -9.0, -1.0, -0.5

_STRIP = ".,;:?!\"'()[]{}<>&%#*$|~`"
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LOOK = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_APART = re.compile(r"\w(?:[.\-_*~']\w){2,}")
#: Three or more single characters with one space between each two.
SPACED = re.compile(r"(?<!\S)[\w@$!|+€£(*](?: [\w@$!|+€£(*]){2,}(?!\S)")


def disguised(token: str) -> bool:
    """Whether the lattice of a token has more than one path."""
    if _TRIPLE.search(token):
        return True
    if not any(c.isalpha() for c in token):
        return False
    return bool(_LOOK.search(token) or _APART.search(token))


def decode(raw: str, logp: list[float]) -> str:
    """The likeliest restored form of a lower-case token or run of spaced letters."""
    apart = " " in raw or bool(_APART.search(raw))
    # state: (code before last, last code, last letter was typed as this character); value: (score, text)
    states: dict[tuple[int, int, str], tuple[float, tuple]] = {(0, 0, ""): (0.0, ())}
    for ch in raw:
        place = place_of(ch)
        options: list[tuple[float, str, int]] = []
        if place:
            options.append((0.0, ch, place))
        if ch in LOOKALIKES:
            options += [(SWAP, x, _PLACE[x]) for x in LOOKALIKES[ch]]
        if not place:
            options.append((KEEP if ch in LOOKALIKES else 0.0, ch, 0))
        after: dict[tuple[int, int, str], tuple[float, tuple]] = {}
        for (a, b, last), (score, out) in states.items():
            row = (a * SIZE + b) * SIZE
            for cost, text, code in options:
                if code == 0:
                    s, key = score + cost + (logp[row] if b else 0.0), (0, 0, "")
                else:
                    s, key = score + cost + logp[row + code], (b, code, text)
                if key not in after or after[key][0] < s:
                    after[key] = (s, (out, text))
            same = last and (ch == last or last in LOOKALIKES.get(ch, ""))
            if same or (apart and ch in SEPARATORS):
                s = score + (DROP_REPEAT if same else DROP_SEPARATOR)
                key = (a, b, last)
                if key not in after or after[key][0] < s:
                    after[key] = (s, out)
        states = after
    best = max(((s + logp[(a * SIZE + b) * SIZE] * (b != 0), out) for (a, b, _), (s, out) in states.items()), key=lambda x: x[0])[1]
    letters = []
    while best:
        best, ch = best
        letters.append(ch)
    return "".join(reversed(letters))


class Restorer:
    """Restores texts under one character model; remembers tokens, up to a bound."""

    REMEMBERED = 60_000

    def __init__(self, logp: list[float], remembers: bool = True):
        self.logp, self.known, self.remembers = logp, {}, remembers

    def words(self, token: str) -> tuple[str, ...]:
        """Restored words of one whitespace token, lower-case, outer punctuation removed."""
        out = self.known.get(token)
        if out is None:
            low = token.lower()
            bare = low.strip(_STRIP)
            # one or two look-alikes at an end may be letters
            edge = low.strip(".,;:?\"'()[]{}<>&%#~`")
            if not bare.isalpha() or _TRIPLE.search(bare) or (0 < len(edge) - len(bare) <= 2 and (edge[0] in "$@|*!" or edge[-1] in "$@|")):
                for form in dict.fromkeys((edge, bare)):
                    if 0 < len(form) - len(bare) <= 2 or form == bare:
                        if disguised(form):
                            bare = decode(form, self.logp).strip(_STRIP)
                            break
            out = tuple(x for x in re.split(r"[^\w]+", bare) if x)
            if self.remembers and len(token) <= 64:
                if len(self.known) >= self.REMEMBERED:
                    self.known.clear()
                self.known[token] = out
        return out

    def runs(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, restored) of runs of spaced single letters."""
        out = []
        for m in SPACED.finditer(text):
            run = m[0].lower()
            if len(set(run)) > 2:  # more than one letter over and over
                out.append((m.start(), m.end(), decode(run, self.logp)))
        return out

    def all_words(self, text: str):
        for token in text.split():
            yield from self.words(token)
        for _, _, run in self.runs(text):
            for token in run.split():
                yield from self.words(token)

    def text(self, text: str) -> str:
        """The whole text with its disguised tokens restored; white space stays."""
        out, at = [], 0
        for a, b, run in self.runs(text):
            out += [text[at:a], run]
            at = b
        text = "".join([*out, text[at:]])

        def one(m: re.Match) -> str:
            words = self.words(m[0])
            plain = tuple(x for x in re.split(r"[^\w]+", m[0].lower().strip(_STRIP)) if x)
            return m[0] if words == plain else " ".join(words)

        return re.sub(r"\S+", one, text)


# ---------------------------------------------------------------- classifier


@dataclass(frozen=True)
class Sample:
    """Bound of the labelled rows to learn from (expected rows of each class; fewer if there are fewer)."""

    toxic: int = 1500
    clean: int = 6000
    seed: int = 17


@dataclass
class Model:
    logp: list[float]
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -20.0


PREFIXES = (4, 5, 6)
#: Least likelihood ratio of a feature's excess in toxic rows (chance below 1e-6), and features kept at most for the fit.
EXCESS, FEATURES = 24.0, 2000


def features_of(word: str) -> list[str]:
    """The word and its first letters; one feature never equals another kind's."""
    return [word, *(f"{word[:n]}\0" for n in PREFIXES if len(word) >= n)]


def _near_copy_key(words: list[str]) -> int:
    """Smallest hash of three-word shingles: near copies mostly share it."""
    return min((xxhash.xxh64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1


def _training_rows(docs: DataFrame, labels: DataFrame, sample: Sample, keep: Column) -> tuple[DataFrame, dict[int, int]]:
    """((text, y) of a bounded sample, labelled rows of each class); the labels side is bounded by ``sample`` and broadcast."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & keep).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, sample.toxic / max(1, n.get(1, 0)))).otherwise(min(1.0, sample.clean / max(1, n.get(0, 0))))
    chosen = known.filter(unit_hash(sample.seed, F.col("id")) < share).limit(2 * (sample.toxic + sample.clean))
    return docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).select("text", "y"), n


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with an L2 penalty by Newton steps with backtracking."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (ridge * w * w).sum())

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-6 * max(1.0, abs(before)):
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: Sample = Sample(), keep: Column | None = None) -> Model:
    """Count the character model over all of ``docs``; learn the classifier from a sample of the labelled rows that ``keep`` allows."""
    rows = id_and_text(docs, id_col, text_col)
    logp = log_model(count_trigrams(rows))
    train, n = _training_rows(rows, labels, sample, F.lit(True) if keep is None else keep)
    share = n.get(1, 0) / max(1, n.get(0, 0) + n.get(1, 0))
    if not n.get(0) or not n.get(1):
        return Model(logp, {}, 40.0 if share == 1 else -40.0)
    train = cut(train)
    held = rows.sparkSession.sparkContext.broadcast(logp)

    def keyed(batches):
        restorer = Restorer(held.value)
        for batch in batches:
            words = [list(restorer.all_words(t)) for t in batch.column("text").to_pylist()]
            bags = [Counter(f for w in ws for f in features_of(w)) for ws in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([_near_copy_key(ws) for ws in words], pa.int64()), pa.array([list(b) for b in bags], pa.list_(pa.string())), pa.array([list(b.values()) for b in bags], pa.list_(pa.int32()))],
                ["y", "near", "feature", "n"],
            )

    bags = cut(map_arrow(train, keyed, "y int, near long, feature array<string>, n array<int>").withColumn("row", F.monotonically_increasing_id()))
    near = bags.groupBy("y", "near").agg(F.count(F.lit(1)).alias("copies"))
    total = {r["y"]: r["n"] for r in near.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    a, b = total.get(1, 0), total.get(0, 0)
    counts = bags.select("y", "near", F.explode("feature").alias("feature")).distinct().groupBy("feature").agg(F.sum(F.col("y")).alias("t"), F.sum(1 - F.col("y")).alias("c"))
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    expected_t, expected_c = (t + c) * a / (a + b), (t + c) * b / (a + b)
    ratio = 2 * (t * F.log(t / expected_t) + F.when(c > 0, c * F.log(c / expected_c)).otherwise(0.0))
    chosen = counts.filter("t >= 2").withColumn("g", ratio).filter((t > expected_t) & (F.col("g") >= EXCESS)).orderBy(F.desc("g"), "feature").limit(FEATURES).collect()
    number = {r["feature"]: k for k, r in enumerate(chosen)}
    names = F.broadcast(rows.sparkSession.createDataFrame([(f, k) for f, k in number.items()], "feature string, k int"))
    cells = bags.select("row", F.explode(F.arrays_zip("feature", "n")).alias("x")).select("row", "x.feature", "x.n").join(names, "feature").groupBy("row").agg(F.collect_list(F.struct("k", "n")).alias("cells"))
    table = bags.select("row", "y", "near").join(near, ["y", "near"]).join(cells, "row", "left").select("y", "copies", "cells").collect()
    x = np.zeros((len(table), len(number)))
    for i, r in enumerate(table):
        for k, count in r["cells"] or ():
            x[i, k] = math.log1p(count)
    y = np.array([r["y"] for r in table], float)
    weight = 1 / np.array([r["copies"] for r in table], float)
    w, bias = _logistic(x, y, weight, penalty=0.1)
    # back from the sample's class shares to those of all labelled rows
    bias += math.log(n[1] / n[0]) - math.log(max(1, int(y.sum())) / max(1, int((1 - y).sum())))
    return Model(logp, {f: float(w[k]) for f, k in number.items() if w[k]}, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (hash of the text), score: probability that the restored text is toxic, over whole texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        # tokens are remembered with their features below
        restorer, weights = Restorer(m.logp, remembers=False), m.weights

        def found(word: str) -> tuple[str, ...]:
            return tuple(f for f in features_of(word) if f in weights)

        of_token: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                bag: Counter = Counter()
                for token in text.split():
                    hits = of_token.get(token)
                    if hits is None:
                        hits = tuple(f for w in restorer.words(token) for f in found(w))
                        if len(of_token) >= Restorer.REMEMBERED:
                            of_token.clear()
                        if len(token) <= 64:
                            of_token[token] = hits
                    if hits:
                        bag.update(hits)
                for _, _, piece in restorer.runs(text):
                    for token in piece.split():
                        for w in restorer.words(token):
                            bag.update(found(w))
                z = m.bias + sum(weights[f] * math.log1p(k) for f, k in bag.items())
                scores.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(scores, pa.float64())], ["doc_id", "key", "score"])

    return map_arrow(id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text"))), run, "doc_id long, key long, score double")


def restored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: every whole text with its disguised words restored."""
    held = docs.sparkSession.sparkContext.broadcast(model.logp)

    def run(batches):
        restorer = Restorer(held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([restorer.text(t) for t in batch.column("text").to_pylist()], pa.string())], ["doc_id", "text"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, text string")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: every fifth by crc32 of the id."""
    return F.coalesce(fold(id_col, 5) == 0, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: Sample = Sample()) -> DataFrame:
    """``docs`` with all its columns, without the documents scored at ``threshold`` or more."""
    model = fit(docs, labels, sample=sample, keep=~held_out())
    return without(docs, score(docs, model).filter(F.col("score") >= threshold))
