"""Quality by a byte-level convolutional network in numpy.

Bytes are embedded; ``FILTERS`` learned filters of ``WIDTH`` bytes run over the
whole document.  Overlapping chunks of ``CHUNK`` bytes (half a chunk apart, the
last one ending with the document) keep each filter's maximum; a small hidden layer
looks at a chunk's maxima, so it also sees what a chunk lacks.  Hidden units are
max-pooled over all chunks and combined into one probability.  A document is
worked off in slices, so memory doesn't grow with its length.

Training takes a bounded sample of labelled rows (``Sample``) to the driver:
gradients only flow through the maxima, which keeps it cheap.  The class shares of
the sample are undone in the last bias.

Defined cases: a null text is empty; an empty text is one chunk of zeros; without
labelled rows of both classes every score is the share of good rows (0.5 if there
are none); a repeated label takes the smaller value; null ids and repeated rows are scored
like any other; columns other than id and text are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, id_and_text, map_arrow, text_bytes, unit_hash

WIDTH, EMBEDDING, FILTERS, HIDDEN = 6, 8, 16, 16
CHUNK, STEP = 256, 128
#: Bytes of a document worked on at a time (a multiple of STEP).
_SLICE = 1 << 16


@dataclass(frozen=True)
class Sample:
    """Bound of the labelled rows to learn from: expected rows of each class, and bytes of a row."""

    good: int = 700
    bad: int = 700
    row_bytes: int = 1 << 16
    epochs: int = 14
    seed: int = 41


Parameters = dict[str, np.ndarray]


def start(seed: int) -> Parameters:
    r = np.random.default_rng(seed)
    return {
        "embed": r.normal(0, 0.6, (256, EMBEDDING)),
        "filter": r.normal(0, 1 / math.sqrt(WIDTH * EMBEDDING), (WIDTH, EMBEDDING, FILTERS)),
        "shift": np.zeros(FILTERS),
        "hidden": r.normal(0, 1 / math.sqrt(FILTERS), (FILTERS + 1, HIDDEN)),
        "hidden_shift": np.full(HIDDEN, 0.1),
        "out": r.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN),
        "out_shift": np.zeros(1),
    }


def byte_tables(p: Parameters) -> np.ndarray:
    """What each byte adds to each filter at each of its places."""
    return np.einsum("be,kef->kbf", p["embed"], p["filter"]).astype(np.float32)


def convolve(data: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Filter values at each place of ``data`` (texts shorter than a filter are padded with zero bytes)."""
    if len(data) < WIDTH:
        data = np.concatenate([data, np.zeros(WIDTH - len(data), np.uint8)])
    m = len(data) - WIDTH + 1
    out = tables[0].take(data[:m], axis=0)
    for k in range(1, WIDTH):
        out += tables[k].take(data[k : k + m], axis=0)
    return out


def chunk_starts(m: int) -> np.ndarray:
    """Chunks over ``m`` places: every STEP, and one that ends with the last place."""
    if m <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, m - CHUNK + 1, STEP)
    return starts if starts[-1] == m - CHUNK else np.r_[starts, m - CHUNK]


def chunk_maxima(values: np.ndarray) -> np.ndarray:
    m = len(values)
    if m <= CHUNK:
        return values.max(0, keepdims=True)
    blocks = values[: m // STEP * STEP].reshape(-1, STEP, values.shape[1]).max(1)
    out = np.maximum(blocks[:-1], blocks[1:])
    if m % STEP:
        out = np.vstack([out, values[m - CHUNK :].max(0)])
    return out


def all_maxima(data: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Chunk maxima of a whole document, slice by slice."""
    if len(data) <= 2 * _SLICE:
        return chunk_maxima(convolve(data, tables))
    out, at = [], 0
    while len(data) - at > 2 * _SLICE:
        # the chunks that start in [at, at + slice)
        out.append(chunk_maxima(convolve(data[at : at + _SLICE - STEP + CHUNK + WIDTH - 1], tables)))
        at += _SLICE
    return np.vstack([*out, chunk_maxima(convolve(data[at:], tables))])


def _filled(n: int) -> float:
    return min(1.0, n / CHUNK)


def forward(p: Parameters, maxima: np.ndarray, filled: float) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(logit, chunk inputs, hidden values, chunk that holds each hidden unit's maximum)."""
    x = np.empty((len(maxima), FILTERS + 1))
    x[:, :FILTERS] = np.maximum(maxima + p["shift"], 0)
    x[:, FILTERS] = filled
    h = np.maximum(x @ p["hidden"] + p["hidden_shift"], 0)
    best = h.argmax(0)
    return float(h[best, np.arange(HIDDEN)] @ p["out"] + p["out_shift"][0]), x, h, best


def gradients(p: Parameters, tables: np.ndarray, data: np.ndarray, y: float, weight: float, to: Parameters, to_tables: np.ndarray) -> float:
    """Adds the gradients of one document; returns its loss."""
    padded = data if len(data) >= WIDTH else np.concatenate([data, np.zeros(WIDTH - len(data), np.uint8)])
    values = convolve(padded, tables)
    maxima = chunk_maxima(values)
    z, x, h, best = forward(p, maxima, _filled(len(data)))
    d = weight * (1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) - y)
    units = np.arange(HIDDEN)
    pooled = h[best, units]
    to["out"] += d * pooled
    to["out_shift"] += d
    dh = d * p["out"] * (pooled > 0)
    to["hidden"] += x[best].T * dh
    to["hidden_shift"] += dh
    dx = dh[:, None] * p["hidden"].T[:, :FILTERS] * (x[best, :FILTERS] > 0)
    to["shift"] += dx.sum(0)
    starts = chunk_starts(len(values))
    chosen, back = np.unique(best, return_inverse=True)
    place = np.stack([starts[c] + values[starts[c] : starts[c] + CHUNK].argmax(0) for c in chosen])
    grad = np.zeros((len(chosen), FILTERS))
    np.add.at(grad, back, dx)
    f = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        np.add.at(to_tables[k], (padded[place + k], f), grad)
    return weight * (math.log1p(math.exp(-abs(z))) + max(z, 0) - y * z)


def train(texts: list[bytes], y: np.ndarray, epochs: int, seed: int, batch: int = 16, rate: float = 0.01, penalty: float = 1e-4) -> Parameters:
    """Adam on the weighted log loss; both classes weigh the same."""
    p, r = start(seed), np.random.default_rng(seed + 1)
    data = [np.frombuffer(t, np.uint8) for t in texts]
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(data))
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            tables, g, g_tables = byte_tables(p), {k: np.zeros_like(v) for k, v in p.items()}, np.zeros((WIDTH, 256, FILTERS))
            for i in part:
                gradients(p, tables, data[i], float(y[i]), float(weight[i]), g, g_tables)
            g["embed"] = np.einsum("kbf,kef->be", g_tables, p["filter"])
            g["filter"] = np.einsum("kbf,be->kef", g_tables, p["embed"])
            step += 1
            now = rate * min(1.0, 2 * (1 - epoch / epochs))
            for k in p:
                grad = g[k] / len(part) + penalty * p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad * grad
                p[k] = p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


@dataclass
class Model:
    parameters: Parameters | None
    #: Added to the logit: undoes the sample's class shares; all there is without a network.
    prior: float

    def probability(self, data: np.ndarray, tables: np.ndarray | None) -> float:
        z = self.prior
        if self.parameters is not None:
            z += forward(self.parameters, all_maxima(data, tables), _filled(len(data)))[0]
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: Sample = Sample(), keep: Column | None = None) -> Model:
    """Learn ``labels.quality`` from a bounded sample of the labelled rows that ``keep`` allows."""
    allowed = F.lit(True) if keep is None else keep
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & allowed).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(F.col("quality").cast("int")).alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    good, bad = n.get(1, 0), n.get(0, 0)
    if not good or not bad:
        return Model(None, 40.0 if good else -40.0 if bad else 0.0)
    share = F.when(F.col("y") == 1, min(1.0, sample.good / good)).otherwise(min(1.0, sample.bad / bad))
    chosen = known.filter(unit_hash(sample.seed, F.col("id")) < share).limit(2 * (sample.good + sample.bad))
    rows = id_and_text(docs, id_col, text_col).filter(F.octet_length("text") <= sample.row_bytes)
    got = sorted((r["id"], r["text"], r["y"]) for r in rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "text", "y").collect())
    y = np.array([r[2] for r in got], float)
    if not len(y) or y.min() == y.max():
        return Model(None, math.log(good / bad))
    # the loss weighs both classes the same, so the prior is that of the labelled rows
    return Model(train([r[1].encode() for r in got], y, sample.epochs, sample.seed), math.log(good / bad))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: probability of good quality, over whole texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        tables = None if m.parameters is None else byte_tables(m.parameters)
        for batch in batches:
            offsets, data = text_bytes(batch.column("text"))
            scores = [m.probability(data[a:b], tables) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return map_arrow(id_and_text(docs, id_col, text_col), run, "doc_id long, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: every fifth by crc32 of the id."""
    return F.coalesce(fold(id_col, 5) == 0, F.lit(False))
