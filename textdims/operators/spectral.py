"""Leading eigenpairs of a correlation matrix that stays a distributed table.

The matrix is a long table of pairs, cut into tiles of ``TILE`` x ``TILE`` numbers.
Its eigenpairs come from a block Lanczos process with full reorthogonalisation: a
panel of at most ``BLOCK`` columns is multiplied by the tiles (one join on the tile's
column, partial products summed by the tile's row), then made orthogonal to all panels before
it.  Panels stay tables of one row for each ``TILE`` variables; only products
of panels, whose sides are numbers of columns, are summed up to the driver, where the
small projected problem is solved.  The process ends when the wanted eigenpairs have
converged, at the latest when the panels span all variables; a panel that is used up
before that is replaced by a fresh one, so that repeated eigenvalues are found too.
A wanted value that comes as often as a panel has columns may come more often than the
panels have met it; then they go on until they span all variables.

Correlations that are missing in the table are zero, so a sparse table stays sparse.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

TILE, BLOCK = 256, 128
#: Residuals, as a share of the largest eigenvalue, at which a pair counts as found; directions below NULL are none.
TOLERANCE, NULL = 1e-9, 1e-10
#: Directions below are so much rounding that they are made orthogonal again once they are written.
FAINT = 1e-5


def reaches(values: np.ndarray, at_least: float) -> np.ndarray:
    """Which values are at least so large, up to rounding (a variable without correlations has an eigenvalue of just one)."""
    return values >= at_least - TOLERANCE


def tiles(corr: DataFrame, index: DataFrame, tile: int = TILE) -> DataFrame:
    """(row, column, numbers): the off-diagonal matrix of ``corr`` (var_i, var_j, r; a pair once) in tiles, both triangles, written once."""
    i, j = (index.select(F.col("var").alias(f"var_{x}"), (F.col("idx") - 1).cast("long").alias(x)) for x in "ij")
    pairs = corr.filter("r <> 0 and var_i <> var_j").join(i, "var_i").join(j, "var_j")
    both = pairs.select(F.explode(F.array(F.struct("i", "j", "r"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r"))).alias("e"))
    size = F.lit(tile)
    cells = both.select(F.floor(F.col("e.i") / size).alias("row"), F.floor(F.col("e.j") / size).alias("column"), (F.col("e.i") % size).alias("y"), (F.col("e.j") % size).alias("x"), F.col("e.r").cast("double").alias("r"))

    def pack(t: pa.Table) -> pa.Table:
        a = np.zeros((tile, tile))
        a[t["y"].to_numpy(), t["x"].to_numpy()] = t["r"].to_numpy()
        return pa.table({"row": t["row"][:1], "column": t["column"][:1], "numbers": pa.array([a.tobytes()], pa.binary())})

    return materialize(cells.groupBy("row", "column").applyInArrow(pack, "row long, column long, numbers binary"), "tiles")


def diagonal(values: DataFrame, tile: int = TILE) -> DataFrame:
    """(part, d): ``values`` (idx, value) in parts of ``tile`` numbers, NaN for numbers that are no variable."""
    size = F.lit(tile)

    def pack(t: pa.Table) -> pa.Table:
        d = np.full(tile, np.nan)
        d[t["y"].to_numpy()] = t["value"].to_numpy()
        return pa.table({"part": t["part"][:1], "d": pa.array([d.tobytes()], pa.binary())})

    at = (F.col("idx") - 1).cast("long")
    return values.select(F.floor(at / size).alias("part"), (at % size).alias("y"), F.col("value").cast("double").alias("value")).groupBy("part").applyInArrow(pack, "part long, d binary")


def _array(blob: bytes, rows: int) -> np.ndarray:
    """A matrix of so many rows (-1: as many as numbers)."""
    return np.frombuffer(blob).reshape(rows, 1 if rows < 0 else -1)


def _each(frame: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row) -> tuples`` over the rows of a small batch at a time."""
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = list(zip(*fn(row), strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return frame.mapInArrow(run, schema)


def _random(part: int, step: int, d: np.ndarray, width: int) -> np.ndarray:
    """A fixed random panel; rows that are no variable stay zero."""
    x = np.random.default_rng([part, step]).standard_normal((len(d), width))
    x[np.isnan(d)] = 0.0
    return x


def _columns(row: dict, first: int, last: int) -> np.ndarray:
    """Columns first..last of a row's panel."""
    d = _array(row["d"], -1)
    return _array(row["q"], len(d))[:, first:last] if last > first else np.zeros((len(d), 0))


def _multiply(tiles_: DataFrame, panels: DataFrame, first: int, last: int) -> DataFrame:
    """``panels`` (part, d, q) with y, the matrix times the columns first..last of q."""

    def product(row):
        v = _array(row["v"], row["rows"])
        yield row["row"], (_array(row["numbers"], row["rows"]) @ v).tobytes()

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(blob.as_buffer()) for blob in t["y"])
        return pa.table({"part": t["part"][:1], "y": pa.array([total.tobytes()], pa.binary())})

    v = _each(panels, lambda row: [(row["part"], len(row["d"]) // 8, _columns(row, first, last).tobytes())], "part long, rows long, v binary")
    parts = _each(tiles_.join(v, F.col("column") == F.col("part")).select("row", "numbers", "rows", "v"), product, "part long, y binary")
    sums = parts.groupBy("part").applyInArrow(add, "part long, y binary")

    def own(row):
        d = np.nan_to_num(np.frombuffer(row["d"]))
        y = d[:, None] * _columns(row, first, last)
        yield row["part"], row["d"], row["q"], (y + _array(row["y"], len(d)) if row["y"] is not None else y).tobytes()

    return _each(panels.join(sums, "part", "left"), own, _CANDIDATES)


_PANELS, _CANDIDATES = "part long, d binary, q binary", "part long, d binary, q binary, y binary"


def _sum(frame: DataFrame, fn, *shape: int) -> np.ndarray:
    """The sum of ``fn(row)``, a small matrix of ``shape``, over all rows; summed by Spark."""

    def cells(row):
        return ((k, float(x)) for k, x in enumerate(np.ravel(fn(row))))

    total = _each(frame, cells, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(int(np.prod(shape)))
    out[total["cell"].to_numpy()] = total["value"].to_numpy()
    return out.reshape(shape)


def _outside(row: dict, m: int, taken: np.ndarray, turn: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """q's ``m`` columns, and y without ``taken`` of them, its columns mixed by ``turn``."""
    q = _columns(row, 0, m)
    y = _array(row["y"], len(q)) - q @ taken
    return q, y if turn is None else y @ turn


def _across(frame: DataFrame, m: int, taken: np.ndarray, turn: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Products of q's ``m`` columns, and of y, with y as ``_outside`` gives it."""
    width = taken.shape[1] if turn is None else turn.shape[1]

    def fn(row):
        q, y = _outside(row, m, taken, turn)
        return np.hstack([q, y]).T @ y

    both = _sum(frame, fn, m + width, width)
    return both[:m], (both[m:] + both[m:].T) / 2


def _orthogonal(panels: DataFrame, first: int, last: int) -> DataFrame:
    """``panels`` whose columns first..last are made orthogonal once more, to each other and to those before."""
    again = _each(panels, lambda row: [(row["part"], row["d"], row["q"], _columns(row, first, last).tobytes())], _CANDIDATES)
    across, gram = _across(again, first, np.zeros((first, last - first)))
    spread, turn = np.linalg.eigh(gram - across.T @ across)
    basis = turn / np.sqrt(spread)
    return materialize(_each(again, lambda row: [(row["part"], row["d"], np.hstack(_outside(row, first, across, basis)).tobytes())], _PANELS), "panels")


class Leading:
    """The leading eigenvalues, descending, and their vectors as a table."""

    def __init__(self, values: np.ndarray, panels: DataFrame | None = None, mix: np.ndarray | None = None):
        self.values, self._panels, self._mix = values, panels, mix

    def _rows(self, turn: np.ndarray):
        mix = self._mix[:, : len(turn)] @ turn

        def rows(row):
            at = np.flatnonzero(~np.isnan(np.frombuffer(row["d"])))
            return at, _columns(row, 0, len(mix))[at] @ mix

        return rows

    def combine(self, turn: np.ndarray) -> DataFrame:
        """(idx, factor, value): the first vectors times the matrix ``turn``, whose columns are the factors from 1."""
        rows = self._rows(turn)

        def cells(row):
            at, v = rows(row)
            base = row["part"] * (len(row["d"]) // 8) + 1
            return ((base + int(y), f + 1, float(x)) for y, numbers in zip(at, v, strict=True) for f, x in enumerate(numbers))

        return _each(self._panels, cells, "idx long, factor long, value double")

    def sum_over(self, turn: np.ndarray, fn, *shape: int) -> np.ndarray:
        """The sum over parts of ``fn(rows of combine(turn) as an array)``."""
        rows = self._rows(turn)
        return _sum(self._panels, lambda row: fn(rows(row)[1]), *shape)


def _settled(h: np.ndarray, left: np.ndarray, width: int, most: int, at_least: float, always: int, block: int, whole: bool):
    """(whether all wanted pairs are found, their values, their vectors in terms of the panels)."""
    values, mix = np.linalg.eigh((h + h.T) / 2)
    values, mix = values[::-1], mix[:, ::-1]
    residual = np.linalg.norm(left @ mix[len(mix) - width :], axis=0)
    wanted = min(int(reaches(values, at_least).sum()), most)
    number = min(max(wanted, always), len(values))
    found = bool((residual[:number] <= TOLERANCE * max(1.0, abs(values[0]))).all())
    if wanted < most and number < len(values):  # the next value has to be below the threshold for certain
        found &= not reaches(values[number] + residual[number], at_least)
    found &= number < len(values)
    repeated = values[: max(0, number - block + 1)] - values[block - 1 : max(number, block - 1)] <= TOLERANCE * max(1.0, abs(values[0]))
    found &= not (repeated.any() and number < max(most, always))
    return found or whole, values[:number], mix[:, :number]


def leading_eigenpairs(tiles_: DataFrame, diagonal_: DataFrame, most: int | None = None, at_least: float = -np.inf, always: int = 0, block: int = BLOCK) -> Leading:
    """The largest eigenvalues: all of at least ``at_least``, ``most`` of them at most if given, and the ``always`` first ones whatever they are.

    A vector's sign makes the sum of its numbers positive.
    """
    panels = materialize(diagonal_.select("part", "d", F.lit(b"").alias("q")), "panels")
    p = int(_sum(panels, lambda row: (~np.isnan(np.frombuffer(row["d"]))).sum(), 1)[0])
    if not p:
        return Leading(np.zeros(0))
    most = p if most is None else most
    h, m, width, step, product = np.zeros((0, 0)), 0, 0, 0, None
    while True:
        if product is None:  # a fresh panel
            width = min(block, p - m)
            candidates = _each(panels, lambda row, w=width, s=step: [(row["part"], row["d"], row["q"], _random(row["part"], s, np.frombuffer(row["d"]), w).tobytes())], _CANDIDATES)
        else:
            candidates = product
        across, gram = _across(candidates, m, np.zeros((m, width)))
        scale = np.sqrt(max(1.0, np.abs(gram).max()))
        kept, basis, left, faint = np.zeros(0, int), None, np.zeros((0, width)), False
        if m < p:
            # what the panels have of it goes twice, and its columns are made orthogonal twice: once is not enough where they are nearly dependent
            more, gram = _across(candidates, m, across)
            across = across + more
            spread, turn = np.linalg.eigh(gram - more.T @ more)
            kept = np.flatnonzero(spread > (NULL * scale) ** 2)[::-1][: p - m]
        if len(kept):
            faint = spread[kept].min() < (FAINT * scale) ** 2
            basis, left = turn[:, kept] / np.sqrt(spread[kept]), np.sqrt(spread[kept])[:, None] * turn[:, kept].T
            more, gram = _across(candidates, m, across, basis)
            spread, turn = np.linalg.eigh(gram - more.T @ more)
            across = across + more @ left
            basis, left = basis @ (turn / np.sqrt(spread)), np.sqrt(spread)[:, None] * turn.T @ left  # left: what the next panel has of the product
        if product is not None:
            grown = np.zeros((m, m))
            grown[: len(h), : len(h)] = h
            grown[:, m - width :] = across
            grown[m - width :, :] = across.T
            h = grown
            found, values, mix = _settled(h, left, width, most, at_least, always, block, m == p)
            if found:
                sums = _sum(panels, lambda row, n=m: _columns(row, 0, n).sum(axis=0), m) @ mix
                return Leading(values, panels, mix * np.where(sums < 0, -1.0, 1.0))
            if not len(kept):  # the panels span an invariant space: go on outside it
                product = None
                continue

        def extend(row, n=m, c=across, b=basis):
            return [(row["part"], row["d"], np.hstack(_outside(row, n, c, b)).tobytes())]

        panels = materialize(_each(candidates, extend, _PANELS), "panels")
        if faint:
            panels = _orthogonal(panels, m, m + len(kept))
        m, width, step = m + len(kept), len(kept), step + 1
        product = materialize(_multiply(tiles_, panels, m - width, m), "products")
