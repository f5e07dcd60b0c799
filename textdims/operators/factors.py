"""Factor analysis, loadings, factor lists and dimension scores.

Components and factors come from the leading eigenpairs of a long correlation table
(``spectral``); the rotation of k factors needs sums of products of k loadings only, so
one aggregate over the variables answers all of it.  Loadings are a long table
``(var, factor, loading)``; the operators below take any such table and grow with the
texts, not on the driver.
"""

from __future__ import annotations

import numpy as np

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fmt_loading, printed
from .spectral import Leading, diagonal, leading_eigenpairs, reaches, tiles

CUTOFF = 0.3
COMMUNALITY_MIN = 0.15


#: Eigenvalues that count as components; eigenvalues of the scree table.
EIGEN_MIN, SCREE = 1.0, 20


def principal_components(corr: DataFrame, index: DataFrame, at_least: float = EIGEN_MIN, most: int | None = None, always: int = 0) -> Leading:
    """Leading eigenpairs of the correlation matrix with ones on its diagonal: all of at least ``at_least``, or the ``most`` largest of them.

    ``corr`` (var_i, var_j, r) holds a pair once and may leave out zeros; ``index`` (var, idx) numbers the variables.
    """
    ones = diagonal(index.select("idx", F.lit(1.0).alias("value")))
    return leading_eigenpairs(tiles(corr, index), ones, most, at_least, always)


def component_loadings(found: Leading, index: DataFrame, at_least: float = EIGEN_MIN, most: int | None = None) -> DataFrame:
    """(var, factor, loading) of the components of at least ``at_least``, all or the ``most`` largest."""
    values = found.values[reaches(found.values, at_least)][:most]
    return _named(found, np.diag(np.sqrt(values)), index)


def _named(found: Leading, turn: np.ndarray, index: DataFrame) -> DataFrame:
    if not len(turn):
        return index.select("var", F.lit(0).alias("factor"), F.lit(0.0).alias("loading")).limit(0)
    cells = found.combine(turn).select("idx", F.col("factor").cast("int").alias("factor"), F.col("value").alias("loading"))
    return cells.join(index.select("var", F.col("idx").cast("long").alias("idx")), "idx").select("var", "factor", "loading")


def eigenvalues(spark, found: Leading) -> DataFrame:
    """(number, eigenvalue), largest first; as many rows as pairs were asked for."""
    rows = [(k + 1, float(x)) for k, x in enumerate(found.values)]
    return spark.createDataFrame(rows, "number long, eigenvalue double")


def _moments(a: np.ndarray) -> np.ndarray:
    """Sums over the rows of the products of two and of four numbers, of the rows and of the rows at unit length; and of the rows."""
    size = np.linalg.norm(a, axis=1, keepdims=True)
    b = np.divide(a, size, out=np.zeros_like(a), where=size > 0)
    fours = [np.einsum("ia,ib,ic,id->abcd", x, x, x, x, optimize=True).ravel() for x in (a, b)]
    return np.concatenate([a.sum(axis=0), (a.T @ a).ravel(), (b.T @ b).ravel(), *fours])


def varimax(twos: np.ndarray, fours: np.ndarray, p: int, sweeps: int = 100) -> np.ndarray:
    """The rotation of k columns that spreads their squares most, from the sums of their products alone.

    Planes are turned in order until no angle is left; each angle is the best one of its plane.
    """
    k = len(twos)
    turn = np.eye(k)
    for _ in range(sweeps):
        largest = 0.0
        for a in range(k):
            for b in range(a + 1, k):
                u, v = twos[a, a] - twos[b, b], 2 * twos[a, b]
                side = fours[a, a, a, a] + fours[b, b, b, b] - 6 * fours[a, a, b, b] - (u * u - v * v) / p
                up = 4 * (fours[a, a, a, b] - fours[a, b, b, b]) - 2 * u * v / p
                angle = np.arctan2(up, side) / 4
                largest = max(largest, abs(angle))
                plane = np.eye(k)
                plane[a, a] = plane[b, b] = np.cos(angle)
                plane[b, a], plane[a, b] = np.sin(angle), -np.sin(angle)
                turn = turn @ plane
                twos = plane.T @ twos @ plane
                fours = np.einsum("abcd,ae,bf,cg,dh->efgh", fours, plane, plane, plane, plane, optimize=True)
        if largest < 1e-13:
            break
    return turn


def promax(twos: np.ndarray, fours: np.ndarray) -> np.ndarray:
    """The oblique turn of varimax loadings towards their cubes, factors at unit variance; from sums of products alone."""
    k = len(twos)
    cubes = np.array([[fours[f, g, g, g] for g in range(k)] for f in range(k)])
    turn = np.linalg.solve(twos, cubes)
    return turn * np.sqrt(np.diag(np.linalg.inv(turn.T @ turn)))


def rotate(corr: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(var, factor, loading): pattern of ``k`` principal factors, rotated by promax (power 3) after varimax at unit row lengths.

    The prior communality of a variable is its largest |r|; factors need a positive
    eigenvalue.  Factors are numbered by their sums of squares, and the sum of their loadings is positive.
    """
    both = corr.select(F.explode(F.array("var_i", "var_j")).alias("var"), F.abs("r").alias("r"))
    prior = index.join(both.groupBy("var").agg(F.max("r").alias("r")), "var", "left").select("idx", F.coalesce("r", F.lit(0.0)).alias("value"))
    found = leading_eigenpairs(tiles(corr, index), diagonal(prior), k, 0.0)
    k = int((found.values > 0).sum())
    if not k:
        return _named(found, np.zeros((0, 0)), index)
    size = np.diag(np.sqrt(found.values[:k]))
    sums = found.sum_over(size, _moments, k + 2 * k * k + 2 * k**4)
    ones, twos, unit_twos, fours, unit_fours = np.split(sums, np.cumsum([k, k * k, k * k, k**4]))
    twos, unit_twos, fours, unit_fours = twos.reshape(k, k), unit_twos.reshape(k, k), fours.reshape([k] * 4), unit_fours.reshape([k] * 4)
    p = index.count()
    straight = varimax(unit_twos, unit_fours, p)
    turned = np.einsum("abcd,ae,bf,cg,dh->efgh", fours, straight, straight, straight, straight, optimize=True)
    turn = straight @ promax(straight.T @ twos @ straight, turned) if k > 1 else np.eye(1)
    turn = turn[:, np.argsort(-np.diag(turn.T @ twos @ turn), kind="stable")]
    turn = turn * np.where(ones @ turn < 0, -1.0, 1.0)
    return _named(found, size @ turn, index)


def communalities(loadings: DataFrame) -> DataFrame:
    """(var, communality): sum of a variable's squared loadings, at most 1."""
    return loadings.groupBy("var").agg(F.least(F.lit(1.0), F.sum(F.col("loading") * F.col("loading"))).alias("communality"))


def split_communality(comm: DataFrame, cutoff: float = COMMUNALITY_MIN):
    """(kept, dropped) variables by communality."""
    return comm.filter(F.col("communality") >= cutoff), comm.filter(F.col("communality") < cutoff)


def scree(eig: DataFrame, n: int = 20) -> DataFrame:
    """First n eigenvalues with their number."""
    return eig.orderBy("number").limit(n)


def assign_loading(loadings: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(var, factor, pole, loading) for variables whose |loading| on one factor is
    strictly larger than on every other factor and >= cutoff; ties -> unassigned."""
    per = loadings.groupBy("var").agg(F.collect_list(F.struct("factor", "loading")).alias("fl"))
    mx = F.array_max(F.transform("fl", lambda s: F.abs(s["loading"])))
    top = F.filter("fl", lambda s: F.abs(s["loading"]) == mx)
    return (
        per.select("var", mx.alias("mx"), top.alias("top"))
        .filter((F.size("top") == 1) & (F.col("mx") >= cutoff))
        .select(
            "var",
            F.col("top")[0]["factor"].alias("factor"),
            F.when(F.col("top")[0]["loading"] > 0, 1).otherwise(-1).alias("pole"),
            F.col("top")[0]["loading"].alias("loading"),
        )
    )


def loading_table(loadings: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Primary loadings per factor/pole, sorted desc (pos) / asc (neg), with labels."""
    prim = assign_loading(loadings, cutoff).join(labels, "var", "left")
    word = F.coalesce(F.col("lemma"), F.col("var"))
    w = Window.partitionBy("factor", "pole").orderBy((F.col("loading") * -F.col("pole")).asc(), F.col("var"))
    return prim.select(
        "factor", "pole", "var", word.alias("word"), "loading",
        F.concat(word, F.lit(" ("), F.col("var"), F.lit(")")).alias("label_full"),
        F.row_number().over(w).alias("rank"),
    )


def factor_entries(loadings: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """E12 entries: primary (word (.45)) and secondary ((word (-.35))) per factor/pole.

    Secondary entries: other factors with |loading| >= cutoff of variables that
    have a primary factor.  Sort key: |loading| as printed, then word.
    """
    prim = assign_loading(loadings, cutoff).select("var", F.col("factor").alias("pfactor"))
    lab = labels.select("var", "lemma")
    j = loadings.join(prim, "var").join(lab, "var", "left")
    word = F.coalesce(F.col("lemma"), F.col("var"))
    is_primary = F.col("factor") == F.col("pfactor")
    j = j.filter(is_primary | (F.abs("loading") >= cutoff))
    fl = fmt_loading(F.col("loading"))
    return j.select(
        "factor",
        F.when(F.col("loading") > 0, 1).otherwise(-1).alias("pole"),
        "var",
        word.alias("word"),
        is_primary.alias("primary"),
        F.when(is_primary, F.concat(word, F.lit(" ("), fl, F.lit(")"))).otherwise(F.concat(F.lit("("), word, F.lit(" ("), fl, F.lit("))"))).alias("entry"),
        F.when(is_primary, F.concat(F.col("var"), F.lit(" ("), fl, F.lit(")"))).otherwise(F.concat(F.lit("("), F.col("var"), F.lit(" ("), fl, F.lit("))"))).alias("entry_id"),
        F.abs(printed(F.col("loading"), 2).cast("double")).alias("sort_key"),
    )


def factor_lists(entries: DataFrame) -> DataFrame:
    """Per factor/pole the sorted list (full, id and primary-only forms) and counts."""
    s = F.struct((-F.col("sort_key")).alias("k"), F.col("word"), F.col("entry"), F.col("entry_id"), F.col("primary"))
    g = entries.groupBy("factor", "pole").agg(F.array_sort(F.collect_list(s)).alias("xs"))
    return g.select(
        "factor", "pole",
        F.size("xs").alias("n_all"),
        F.size(F.filter("xs", lambda x: x["primary"])).alias("n_primary"),
        F.array_join(F.transform("xs", lambda x: x["entry"]), ", ").alias("words"),
        F.array_join(F.transform("xs", lambda x: x["entry_id"]), ", ").alias("var_ids"),
        F.array_join(F.transform(F.filter("xs", lambda x: x["primary"]), lambda x: x["entry"]), ", ").alias("primary_words"),
    )


def pole_counts(entries: DataFrame) -> DataFrame:
    """Variables per pole, all and primary only."""
    return entries.groupBy("factor", "pole").agg(
        F.count(F.lit(1)).alias("n_all"), F.sum(F.col("primary").cast("long")).alias("n_primary")
    )


def factor_scores(texts: DataFrame, hits: DataFrame, primary: DataFrame, k: int) -> DataFrame:
    """score(text, factor) = sum of pole over present primary-loaded variables (raw 0/1); 0 when none."""
    s = hits.join(primary.select("var", "factor", "pole"), "var").groupBy("text_id", "factor").agg(F.sum("pole").alias("score"))
    grid = texts.select("text_id", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("factor"))
    return grid.join(s, ["text_id", "factor"], "left").select("text_id", "factor", F.coalesce("score", F.lit(0)).cast("long").alias("score"))


def used_words(texts: DataFrame, hits: DataFrame, primary: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """Per text x factor x pole: number and sorted list of present primary-loaded words."""
    p = primary.select("var", "factor", "pole").join(labels.select("var", "lemma"), "var", "left")
    h = hits.join(p, "var").groupBy("text_id", "factor", "pole").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_list(F.coalesce("lemma", "var"))), ", ").alias("words"),
    )
    fp = F.array(*[F.struct(F.lit(f).alias("factor"), F.lit(pl).alias("pole")) for f in range(1, k + 1) for pl in (1, -1)])
    grid = texts.select("text_id", F.explode(fp).alias("fp")).select("text_id", "fp.factor", "fp.pole")
    return grid.join(h, ["text_id", "factor", "pole"], "left").select(
        "text_id", "factor", "pole", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("words", F.lit("")).alias("words")
    )


def scores_wide(scores: DataFrame, k: int) -> DataFrame:
    """J6 helper: (text_id, fac1..fack) from the long score table."""
    return scores.groupBy("text_id").pivot("factor", list(range(1, k + 1))).agg(F.first("score")).select(
        "text_id", *[F.col(str(f)).alias(f"fac{f}") for f in range(1, k + 1)]
    )
