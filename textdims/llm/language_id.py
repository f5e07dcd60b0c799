"""Language identification in two steps: family, then close languages within it.

A document is the vector of its hashed byte bigrams, trigrams and letter-edge
grams (square roots of the counts, length one), over the whole text.  A softmax regression
predicts the language family; within a family every two languages have a
linear support vector machine of their own (squared hinge loss), and the language
with the most votes wins, margins deciding ties.

Training uses a bounded sample of labelled rows of every language (``Sample``),
chosen by a hash of the id so that it is the same at any number of partitions;
vectors are made on the executors.

Defined cases: a null text, and one without a letter, is ``und`` with score 0;
without labelled rows every text is ``und``; one learned language is predicted
everywhere; null ids and repeated rows are predicted like any other; columns other
than id and text are never inputs of a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, map_arrow, text_bytes, unit_hash

UNKNOWN = "und"
#: Families of languages by their two-letter codes; a language not named is a family of its own.
FAMILIES = {
    "germanic": "en de nl af fy lb sv da no nb nn is fo yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi bn ur pa mr ne gu".split(),
    "semitic": "ar he mt am".split(),
    "celtic": "ga cy gd br".split(),
    "austronesian": "id ms tl jv".split(),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

#: Places of the hashed vector, and bytes handled at a time.
WIDTH = 1 << 12
_SLICE = 1 << 20


@dataclass(frozen=True)
class Sample:
    """Expected rows of each language to learn from (fewer if there are fewer)."""

    rows: int = 600
    seed: int = 29


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


# ---------------------------------------------------------------- vectors

#: Bytes as the grams see them: A-Z folded, all other ASCII but a-z one sign (a word edge).
_SEEN = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256)], np.uint32)


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of the bigram and of the trigram that start at each byte but the last two."""
    x = _SEEN[data]
    two = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77)
    three = (two ^ np.uint32(0x2C1B3C6D)) + x[2:] * np.uint32(0xC2B2AE3D)
    mix = np.uint32(0x7FEB352D)
    return ((two * mix) >> np.uint32(20)), ((three * mix) >> np.uint32(20))


def vectors(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One vector of length one for each text of a batch."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    for i in range(n):
        counts = np.zeros(WIDTH, np.int64)
        a, b = int(offsets[i]), int(offsets[i + 1])
        edge = np.array([32], np.uint8)
        for at in range(a, b, _SLICE):
            part = np.concatenate([edge if at == a else data[at - 2 : at], data[at : min(b, at + _SLICE)], edge if at + _SLICE >= b else edge[:0]])
            if len(part) > 2:
                two, three = _grams(part)
                counts += np.bincount(two, minlength=WIDTH) + np.bincount(three, minlength=WIDTH)
        row = np.sqrt(counts)
        out[i] = row / max(1e-9, float(np.sqrt((row * row).sum())))
    return out


# ---------------------------------------------------------------- learning


def softmax_regression(x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 150, rate: float = 20.0, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by gradient descent with momentum; classes weigh the same."""
    w, b = np.zeros((classes, x.shape[1])), np.zeros(classes)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    goal = np.eye(classes)[y]
    weight = (1 / (classes * np.bincount(y, minlength=classes).clip(1)))[y][:, None]
    for _ in range(rounds):
        z = x @ w.T + b
        p = np.exp(z - z.max(1, keepdims=True))
        g = weight * (p / p.sum(1, keepdims=True) - goal)
        vw = 0.9 * vw - rate * (g.T @ x + penalty * w)
        vb = 0.9 * vb - 0.1 * rate * g.sum(0)
        w, b = w + vw, b + vb
    return w, b


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 40, seed: int = 5) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM (y is -1 or 1) by dual coordinate descent."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, alpha, square, order = np.zeros(x1.shape[1]), np.zeros(len(x)), (x1 * x1).sum(1) + 0.5 / c, np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(x)):
            g = y[i] * (x1[i] @ w) - 1 + alpha[i] * 0.5 / c
            if alpha[i] > 0 or g < 0:
                new = max(0.0, alpha[i] - g / square[i])
                w += (new - alpha[i]) * y[i] * x1[i]
                most, alpha[i] = max(most, abs(g)), new
        if most < 0.05:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    families: list[str]
    family_weights: np.ndarray
    family_bias: np.ndarray
    #: Languages of each family, and a machine for each two of them.
    languages: dict[str, list[str]]
    machines: dict[tuple[str, str], tuple[np.ndarray, float]]

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        z = x @ self.family_weights.T + self.family_bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        margins = {pair: x @ w + b for pair, (w, b) in self.machines.items()}
        out = []
        for i, f in enumerate(p.argmax(1).tolist()):
            languages = self.languages[self.families[f]]
            votes = dict.fromkeys(languages, 0.0)
            sure = dict.fromkeys(languages, 0.0)
            for a, b in combinations(languages, 2):
                m = float(margins[a, b][i])
                votes[a if m > 0 else b] += 1
                sure[a] += m
                sure[b] -= m
            best = max(languages, key=lambda lang: (votes[lang], sure[lang], lang))
            inner = 1.0
            for a, b in combinations(languages, 2):
                if best in (a, b):
                    m = float(margins[a, b][i]) * (1 if best == a else -1)
                    inner = min(inner, 1 / (1 + float(np.exp(-3 * m))))
            out.append((best, float(p[i, f]) * inner))
        return out


def _training(docs: DataFrame, sample: Sample, id_col: str, text_col: str, lang_col: str, keep: Column) -> tuple[np.ndarray, list[str]]:
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & keep)
    n = {r[0]: r[1] for r in known.groupBy(F.col(lang_col).cast("string")).count().collect()}
    if not n:
        return np.zeros((0, WIDTH)), []
    share = F.create_map(*[F.lit(x) for lang, k in sorted(n.items()) for x in (lang, min(1.0, sample.rows / k))])
    chosen = known.filter(unit_hash(sample.seed, F.col(id_col)) < F.element_at(share, F.col(lang_col).cast("string")))
    rows = id_and_text(chosen, id_col, text_col, F.col(lang_col).cast("string").alias("lang"))

    def run(batches):
        for batch in batches:
            x = vectors(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["doc_id", "lang", "x"])

    got = sorted(map_arrow(rows, run, "doc_id long, lang string, x binary").collect(), key=lambda r: (r["doc_id"] or 0, r["x"]))
    return np.array([np.frombuffer(r["x"], np.float16) for r in got], np.float32).reshape(len(got), WIDTH), [r["lang"] for r in got]


def fit(docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: Column | None = None) -> Model | None:
    """Learn from a bounded sample of the rows with a language that ``keep`` allows."""
    x, langs = _training(docs, sample, id_col, text_col, lang_col, F.lit(True) if keep is None else keep)
    if not langs:
        return None
    languages: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        languages.setdefault(family_of(lang), []).append(lang)
    families = sorted(languages)
    y = np.array([families.index(family_of(lang)) for lang in langs])
    w, b = softmax_regression(x, y, len(families))
    machines = {}
    all_langs = np.array(langs)
    for of in languages.values():
        for one, two in combinations(of, 2):
            rows = (all_langs == one) | (all_langs == two)
            machines[one, two] = linear_svm(x[rows], np.where(all_langs[rows] == one, 1.0, -1.0))
    return Model(families, w.astype(np.float32), b.astype(np.float32), languages, {k: (v.astype(np.float32), c) for k, (v, c) in machines.items()})


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of each whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            lettered = [m is not None and any(map(str.isalpha, t)) for t in batch.column("text").to_pylist()]
            out = [(UNKNOWN, 0.0)] * len(lettered)
            at = np.flatnonzero(lettered)
            for part in np.array_split(at, max(1, len(at) // 256)) if len(at) else ():
                taken = batch.column("text").take(pa.array(part))
                for i, found in zip(part.tolist(), m.predict(vectors(*text_bytes(taken))), strict=True):
                    out[i] = found
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: every third by crc32 of the id."""
    return F.coalesce(fold(id_col, 3) == 1, F.lit(False))
